"""Format-preserving pseudonyms for personal data, on SQL functions alone.

Values are found by pattern and checked: card numbers by their check digit, dates by the
calendar, addresses by their ranges, social security numbers by their numbering rules. Telephone
numbers are judged by their format alone. What passes is replaced by a keyed permutation of the values of its format, so it keeps
length, punctuation and validity, and equal values get equal pseudonyms in every document.

The permutation is a Feistel network of ``ROUNDS`` rounds with SHA-256 of key, kind, round and
one half as round function. Strings (card and telephone digits, local parts of mail addresses,
secrets) shift each letter or digit of one half within its class; numbers (dates, addresses,
social security numbers) are pairs of residues whose moduli multiply to the number of values.
The key is a secret; it stands in query plans like any literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DEFAULT_KEY = "tidemark-pseudonyms"

# A cycle of the calendar, 400 years from this day, has 146,097 = 189 * 773 days.
_CYCLE_START, _CYCLE_DAYS, _DATE_MODULI = "1700-01-01", 146_097, (189, 773)
_FIRST_YEAR, _LAST_YEAR = 1300, 2499

# The formats. A value neither begins nor ends inside a longer word or number.
_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_FORMATS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)*[.][A-Za-z]{2,}",
    "phone": _BEFORE
    + r"(?:[+]?[0-9]{1,3}[ .-]?)?(?:[(][0-9]{3}[)][ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    + _AFTER,
    "grouped": r"(?<![\p{L}\p{N}+])[+][1-9](?:[ ./-]?[(]?[0-9][)]?){8,14}" + _AFTER,
    "ssn": _BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _AFTER,
    "date": _BEFORE
    + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}[.][0-9]{2}[.][0-9]{4})"
    + _AFTER,
    "ip": r"(?<![\p{L}\p{N}.])[0-9]{1,3}(?:[.][0-9]{1,3}){3}(?![\p{L}\p{N}]|[.][0-9])",
    "card": _BEFORE
    + r"(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"
    + _AFTER,
    "secret": r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{40}|[0-9A-F]{64})(?![\p{L}\p{N}])"
    r"|(?<=(?i:password|passwd|secret|token|api_key) {0,1}[=:] {0,1}[\"']{0,1})[A-Za-z0-9+/_-]{8,}",
}
_ANY = "|".join(f"(?:{p})" for p in _FORMATS.values())


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _round_number(key: str, kind: str, step: str, half: str) -> str:
    digest = f"sha2(concat_ws('|', {_text(key)}, '{kind}', {step}, {half}), 256)"
    return f"CAST(conv(substr({digest}, 1, 14), 16, 10) AS BIGINT)"


_CLASSES = (("0", "9", 10), ("a", "z", 26), ("A", "Z", 26))
_HEX = (("0", "9", 10), ("a", "f", 6))
_UPPER_HEX = (("0", "9", 10), ("A", "F", 6))


def _string_cipher(key: str, kind: str, value: str, classes: tuple = _CLASSES) -> str:
    """Permute a string; letters and digits stay in their class, the rest stays as it is."""
    digest = f"sha2(concat_ws('|', {_text(key)}, '{kind}', CAST(i AS STRING), s.r), 256)"
    amount = "CAST(conv(substr(h, 2 * (k % 32) + 1, 2), 16, 10) AS INT)"
    shifted = _choice(
        [
            (f"c BETWEEN '{a}' AND '{z}'", f"chr(ascii('{a}') + (ascii(c) - ascii('{a}') + {amount}) % {n})")
            for a, z, n in classes
        ],
        "c",
    )
    other = (
        f"transform(array({digest}), h -> if(s.l = '', '',"
        f" array_join(transform(split(s.l, ''), (c, k) -> {shifted}), '')))[0]"
    )
    half = f"CAST(length({value}) DIV 2 AS INT)"
    return (
        f"aggregate(sequence(1, {ROUNDS}),"
        f" named_struct('l', substr({value}, 1, {half}), 'r', substr({value}, {half} + 1)),"
        f" (s, i) -> named_struct('l', s.r, 'r', {other}), s -> concat(s.l, s.r))"
    )


def _number_cipher(key: str, kind: str, x: str, y: str, moduli: tuple, result: str) -> str:
    """Permute the pair (x, y) of residues; ``result`` is an expression of s.x and s.y."""
    a, b = moduli
    on_x = f"pmod(s.x + {_round_number(key, kind, 'CAST(i AS STRING)', 'CAST(s.y AS STRING)')}, CAST({a} AS BIGINT))"
    on_y = f"pmod(s.y + {_round_number(key, kind, 'CAST(i AS STRING)', 'CAST(s.x AS STRING)')}, CAST({b} AS BIGINT))"
    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('x', CAST({x} AS BIGINT), 'y', CAST({y} AS BIGINT)),"
        f" (s, i) -> named_struct('x', if(i % 2 = 1, {on_x}, s.x), 'y', if(i % 2 = 0, {on_y}, s.y)),"
        f" s -> {result})"
    )


def _choice(branches: list[tuple[str, str]], other: str) -> str:
    """The value of the first test that holds, as ``CASE`` has it.

    The parser reads ``CASE`` to its end before it knows its form, once for every level and all
    over again, and keeps what it has seen; ``if`` it knows at once.
    """
    for test, value in reversed(branches):
        other = f"if({test}, {value}, {other})"
    return other


def _bind(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _luhn_sum(digits: str) -> str:
    """The sum of the check-digit rule over digits that a check digit is to follow."""
    d = f"CAST(substr({digits}, length({digits}) - j, 1) AS INT)"
    return (
        f"aggregate(sequence(0, length({digits}) - 1), 0,"
        f" (t, j) -> t + if(j % 2 = 0, if({d} > 4, 2 * {d} - 9, 2 * {d}), {d}))"
    )


def _refill(digits: str) -> str:
    """The match ``m`` with its digits replaced in order."""
    seen = "length(regexp_replace(substr(m, 1, q + 1), '[^0-9]', ''))"
    return (
        f"array_join(transform(split(m, ''), (c, q) ->"
        f" if(c BETWEEN '0' AND '9', substr({digits}, {seen}, 1), c)), '')"
    )


_DIGITS = "regexp_replace(m, '[^0-9]', '')"


def _card(key: str) -> str:
    # The first digit stays, the check digit follows from the others.
    middle = _string_cipher(key, "card", "substr(d, 2, length(d) - 2)")
    payload = f"concat(substr(d, 1, 1), {middle})"
    check = f"CAST((10 - {_luhn_sum('p')} % 10) % 10 AS STRING)"
    new = _bind("n", _bind("p", payload, f"concat(p, {check})"), _refill("n"))
    valid = f"({_luhn_sum('substr(d, 1, length(d) - 1)')} + CAST(right(d, 1) AS INT)) % 10 = 0"
    return _bind("d", _DIGITS, f"if({valid}, {new}, m)")


def _phone(key: str) -> str:
    # Country code and the first digits of area and exchange stay.
    local = "right(d, 10)"
    free = f"concat(substr({local}, 2, 2), substr({local}, 5, 6))"
    new = _bind(
        "f",
        _string_cipher(key, "phone", free),
        f"concat(substr(d, 1, length(d) - 10), substr({local}, 1, 1), substr(f, 1, 2),"
        f" substr({local}, 4, 1), substr(f, 3, 6))",
    )
    return _bind("d", _DIGITS, _bind("n", new, _refill("n")))


def _grouped(key: str) -> str:
    # International numbers in any grouping: the first two digits, all or most of the country code, stay.
    new = f"concat(left(d, 2), {_string_cipher(key, 'phone', 'substr(d, 3)')})"
    return _bind("d", _DIGITS, _bind("n", new, _refill("n")))


def _ssn(key: str) -> str:
    area = "CAST(substr(m, 1, 3) AS INT)"
    x = f"(({area} - if({area} > 666, 2, 1)) * 99 + CAST(substr(m, 5, 2) AS INT) - 1)"
    y = "CAST(substr(m, 8, 4) AS INT) - 1"
    place = "(s.x DIV 99)"
    new = (
        f"concat_ws('-', lpad(CAST({place} + if({place} >= 665, 2, 1) AS STRING), 3, '0'),"
        f" lpad(CAST(s.x % 99 + 1 AS STRING), 2, '0'), lpad(CAST(s.y + 1 AS STRING), 4, '0'))"
    )
    valid = (
        f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND substr(m, 5, 2) <> '00' AND substr(m, 8, 4) <> '0000'"
    )
    return f"if({valid}, {_number_cipher(key, 'ssn', x, y, (898 * 99, 9999), new)}, m)"


def _ip(key: str) -> str:
    # Every octet keeps its number of digits: 0 to 9, 10 to 99 or 100 to 255.
    octets = [f"split(m, '[.]')[{k}]" for k in range(4)]
    size = [_choice([(f"length({o}) = 1", "10"), (f"length({o}) = 2", "90")], "156") for o in octets]
    base = [_choice([(f"length({o}) = 1", "0"), (f"length({o}) = 2", "10")], "100") for o in octets]
    index = [f"(CAST({o} AS INT) - {b})" for o, b in zip(octets, base)]
    digits = [
        f"CAST(s.{half} {step} ({size[second]}) + {base[k]} AS STRING)"
        for k, half, step, second in ((0, "x", "DIV", 1), (1, "x", "%", 1), (2, "y", "DIV", 3), (3, "y", "%", 3))
    ]
    valid = " AND ".join(f"CAST({o} AS INT) <= 255 AND (length({o}) = 1 OR left({o}, 1) <> '0')" for o in octets)
    cipher = _number_cipher(
        key,
        "ip",
        f"{index[0]} * ({size[1]}) + {index[1]}",
        f"{index[2]} * ({size[3]}) + {index[3]}",
        (f"({size[0]}) * ({size[1]})", f"({size[2]}) * ({size[3]})"),
        f"concat_ws('.', {', '.join(digits)})",
    )
    return f"if({valid}, {cipher}, m)"


def _date(key: str) -> str:
    branches = []
    for like, java, year, month, day in (
        ("____-__-__", "yyyy-MM-dd", 1, 6, 9),
        ("__/__/____", "MM/dd/yyyy", 7, 1, 4),
        ("__.__.____", "dd.MM.yyyy", 7, 4, 1),
    ):
        parsed = f"try_to_date(concat_ws('-', substr(m, {year}, 4), substr(m, {month}, 2), substr(m, {day}, 2)), 'yyyy-MM-dd')"
        offset = f"datediff(t, DATE'{_CYCLE_START}')"
        index = f"pmod({offset}, {_CYCLE_DAYS})"
        new = f"date_format(date_add(DATE'{_CYCLE_START}', CAST(s.x * {_DATE_MODULI[1]} + s.y + {offset} - {index} AS INT)), '{java}')"
        cipher = _number_cipher(key, "date", f"{index} DIV {_DATE_MODULI[1]}", f"{index} % {_DATE_MODULI[1]}", _DATE_MODULI, new)
        body = f"if(year(t) BETWEEN {_FIRST_YEAR} AND {_LAST_YEAR}, {cipher}, m)"
        branches.append((f"m LIKE '{like}'", _bind("t", parsed, body)))
    return _choice(branches, "m")


def _email(key: str) -> str:
    local, domain = "substring_index(m, '@', 1)", "substring_index(m, '@', -1)"
    return f"concat({_string_cipher(key, 'email', local)}, '@', {domain})"


def _pseudonym(key: str) -> str:
    """The replacement of the match ``m``."""
    kinds = {"email": _email(key), "phone": _phone(key), "grouped": _grouped(key), "ssn": _ssn(key), "date": _date(key), "ip": _ip(key), "card": _card(key)}
    branches = [(f"m RLIKE {_text('^(?:' + _FORMATS[k] + ')$')}", kinds[k]) for k in kinds]
    hexadecimal = _string_cipher(key, "secret", "m", _HEX)
    upper_hexadecimal = _string_cipher(key, "secret", "m", _UPPER_HEX)
    access_key = f"concat('AKIA', {_string_cipher(key, 'secret', 'substr(m, 5)')})"
    other = _string_cipher(key, "secret", "m")
    branches += [
        ("m RLIKE '^[0-9a-f]+$'", hexadecimal),
        ("m RLIKE '^([0-9A-F]{40}|[0-9A-F]{64})$'", upper_hexadecimal),
        ("m RLIKE '^AKIA[0-9A-Z]{16}$'", access_key),
    ]
    return _choice(branches, other)


def pseudonyms(text_col: str = "text", key: str = DEFAULT_KEY) -> Column:
    """The text with every checked value replaced; null stays null."""
    text = f"`{text_col}`"
    found = f"regexp_extract_all({text}, {_text(_ANY)}, 0)"
    rest = f"split({text}, {_text(_ANY)}, -1)"
    # Few levels around the long expression: each costs the parser memory that it keeps.
    new = f"transform(ms, m -> {_pseudonym(key)})"
    rebuilt = f"array_join(zip_with({rest}, {new}, (part, n) -> concat(part, ifnull(n, ''))), '')"
    replaced = F.expr(_bind("ms", found, f"if(size(ms) = 0, {text}, {rebuilt})"))
    return F.when(F.expr(f"{text} RLIKE '[0-9@=:]'"), replaced).otherwise(F.expr(text))


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY) -> DataFrame:
    """All rows and columns of ``docs`` with pseudonyms in the text.

    Lengths do not change. Null and empty texts stay as they are; repeated rows get the same
    pseudonyms; other columns are passed on, whatever their names; no rows give no rows. What
    looks like a value and fails its check stays.
    """
    return docs.withColumn(text_col, pseudonyms(text_col, key))
