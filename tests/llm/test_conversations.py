"""Repairs of conversations, against dynamic programming over edit texts and exhaustive search."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import conversations, queries

SMALL = "/root/testdata/sf0.001"
EMPTY = hashlib.sha256(b"").hexdigest()


def valid(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def cheapest(symbols):
    """(cost, audit, roles of what is left) by comparing whole edit texts, without any table."""
    after = {"": {"u": "u", "s": "s"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def closed(best):
        for _ in range(4):
            for state, options in after.items():
                for new in set(options) - {"s"}:
                    cost, text, roles = best[new]
                    best[state] = min(best[state], (cost + 3, "I" + text, (new.upper(), *roles)))
        return best

    never = (10**9, "", ())
    best = closed({"": (0, "", ()), "s": never, "u": never, "a": (0, "", ())})
    for symbol in reversed(symbols):
        now = {}
        for state, options in after.items():
            found = [(best[state][0] + 4, "D" + best[state][1], best[state][2])]
            if symbol != "d":
                extra = 3 if symbol.isupper() else 0
                kept = options.get(symbol.lower())
                if kept:
                    found.append((best[kept][0] + extra, "K" + best[kept][1], ("k", *best[kept][2])))
                for new in set(options) - {"s"}:
                    found.append((best[new][0] + 3 + extra, "R" + best[new][1], (new, *best[new][2])))
            now[state] = min(found)
        best = closed(now)
    return best[""]


def fault_rows(rows):
    """The rows of one conversation in order with their fault."""
    seen, out = set(), []
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))
    for turn, role, text in ordered:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
            fault = "truncated"
        else:
            fault = ""
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute_force(rows):
    rows = fault_rows(rows)
    initial = [r[1][:1] if r[1][:1] in ("s", "u", "a") else "o" for r in rows]
    symbols = [
        "d" if r[3] in ("blank", "duplicate") else i.upper() if r[3] else i for i, r in zip(initial, rows)
    ]
    cost, audit, roles = cheapest(symbols)
    lines, at, place = [], 0, iter(roles)
    for edit in audit:
        if edit == "I":
            lines.append({"U": "user:", "A": "assistant:"}[next(place)])
            continue
        _, role, text, _ = rows[at]
        at += 1
        if edit != "D":
            what = next(place)
            lines.append({"k": role, "u": "user", "a": "assistant"}[what] + ":" + text)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults = [sum(r[3] == f for r in rows) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (_, a, _, _), (_, b, _, _) in itertools.pairwise(rows))
    return (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)


def expected(rows):
    rows = list(rows)
    by_conv = {r[0]: [] for r in rows}
    for conv, *row in damaged(rows):
        by_conv[conv].append(tuple(row))
    return {c: brute_force(r) if r else (0, 0, 0, 0, 0, 0, "", EMPTY) for c, r in by_conv.items()}


def query_rows(spark, tmp_path, df):
    df.write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    out = queries.op13_conversations(spark, str(tmp_path)).collect()
    assert len(out) == len({r.conv_id for r in out})
    return {r.conv_id: tuple(r)[1:] for r in out}


SYMBOLS = "suaoSUAOd"


def tabled(symbols):
    """Cost and audit by the tables, in segments of all sizes."""
    letters, before, cost, left = conversations.trace(symbols, conversations.tables().end, 0)
    t = conversations.tables()
    text = "".join(letters) + ("", "ua", "a", "")[left]
    return int(t.costs[before, 0]) + cost, text.translate(str.maketrans("UAua", "RRII"))


@pytest.mark.parametrize("length", range(5))
def test_tables_on_all_short_conversations(length):
    for symbols in map("".join, itertools.product(SYMBOLS, repeat=length)):
        assert tabled(symbols) == cheapest(symbols)[:2], symbols


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=SYMBOLS, min_size=5, max_size=60), st.integers(1, 30))
def test_tables_and_segments_on_longer_conversations(symbols, cut):
    cost, audit, _ = cheapest(symbols)
    assert tabled(symbols) == (cost, audit)
    parts = [symbols[i : i + cut] for i in range(0, len(symbols), cut)]
    summaries = [conversations.summarise(p) for p in parts]
    behind = [conversations.tables().end]
    for vector, _, _ in summaries[:0:-1]:
        behind.append(int(vector[behind[-1]]))
    state, text = 0, ""
    for part, b, (vector, added, exits) in zip(parts, behind[::-1], summaries):
        letters, before, paid, left = conversations.trace(part, b, state)
        assert (before, paid, left) == (vector[b], added[b], exits[b, state])
        text, state = text + "".join(letters), left
    text += ("", "ua", "a", "")[state]
    assert text.translate(str.maketrans("UAua", "RRII")) == audit


def test_the_plain_version_is_the_cheapest_of_all_edits():
    """Every edit text with up to three insertions, tried one by one."""
    for symbols in map("".join, itertools.product("suaSd", repeat=3)):
        best = (10**9, "")
        for edits in itertools.product("DKUA", repeat=3):
            if any(s == "d" and e != "D" for s, e in zip(symbols, edits)):
                continue
            for inserted in itertools.product(("", "u", "a", "ua", "au"), repeat=4):
                roles, text, cost = inserted[0], "I" * len(inserted[0]), 3 * sum(map(len, inserted))
                for s, e, more in zip(symbols, edits, inserted[1:]):
                    roles += {"D": "", "K": s.lower(), "U": "u", "A": "a"}[e] + more
                    text += {"D": "D", "K": "K", "U": "R", "A": "R"}[e] + "I" * len(more)
                    cost += {"D": 4, "K": 0, "U": 3, "A": 3}[e] + (3 if s.isupper() and e != "D" else 0)
                if valid(roles):
                    best = min(best, (cost, text))
        assert cheapest(symbols)[:2] == best, symbols


def test_whole_table(spark, tmp_path):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert query_rows(spark, tmp_path, turns) == expected(rows)


AWKWARD = [
    (1, 0, "user", "Hi."),
    (1, 0, "user", "Hi."),
    (1, 0, "user", "Hi."),
    (1, None, "assistant", "no time!"),
    (1, None, None, None),
    (2, None, "system", "Rules."),
    (2, None, "", "no role?"),
    (3, 5, "user", None),
    (None, 1, "user", "a text"),
    (None, None, "assistant", "x" * 200_000 + ". \n"),
    (4, 9, "tool", "out."),
    (4, 3, "User", "capital."),
    (4, 4, "ünder", "other\nline!  "),
    (5, -3, "user", "\x0b \t"),
    (5, 2**40, "assistant", "far."),
    (6, 1, "user", "same."),
    (6, 2, "assistant", "same."),
    (6, 3, "user", "same."),
    (6, 4, "assistant", "same."),
]


def test_awkward_conversations(spark, tmp_path):
    rows = AWKWARD + [(100 + k, t, r, x) for k in range(60) for _, t, r, x in AWKWARD]
    df = spark.createDataFrame(rows, "conv_id int, turn bigint, role string, text string")
    df = df.selectExpr("*", "'x' AS conv", "1 AS letters", "2 AS segment", "'y' AS digest")
    assert query_rows(spark, tmp_path, df) == expected(rows)
    assert query_rows(spark, tmp_path, df.where("false")) == {}


def test_one_long_conversation_in_many_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT_BITS", 3)
    roles = ("user", "assistant", "system", "tool", "user", "assistant")
    rows = [
        (k % 7 // 6, (k * 7919) % 900, roles[k % 6], f"text {k % 250}" + "." * (k % 3)) for k in range(1500)
    ]
    rows += [(0, 950, "assistant", "again and again.")] * 300
    df = spark.createDataFrame(rows, "conv_id int, turn bigint, role string, text string")
    assert query_rows(spark, tmp_path, df) == expected(rows)
