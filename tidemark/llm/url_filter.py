"""URL verdicts by rules, and by gradient-boosted trees on lexical features where no rule fits.

A rule names a host and the beginning of a path. It fits its host and all subdomains; the longest
of the fitting rules decides, and of equally long ones the blocking one. The URLs that rules
decide are the labelled examples: trees are boosted on them (logistic loss, histograms of
quantile bins, Newton steps) and judge all others.

Features of a URL are lengths, depths, shares of digits, entropies, counts of parameters, and
statistics of suffixes: how often the examples with the same last label, the same last two labels
of the host and the same file suffix are blocked. An example's own fold is left out of its
suffix statistics while the trees are trained, so that they do not learn the labels back.

The examples are a bounded sample: the ``max_examples`` different labelled URLs with the smallest
hashes. The model has the size of that sample at most and is sent to every task. Rules are applied
by built-in functions and every URL is judged whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import column, text_chunks

MAX_EXAMPLES = 20_000
MAX_RULES = 500
TREES = 60
DEPTH = 4
RATE = 0.15
BINS = 64
MIN_LEAF_WEIGHT = 1.0
RIDGE = 1.0
FOLDS = 5
SMOOTHING = 20.0  # a suffix counts as so many more examples at the overall rate
THRESHOLD = 0.5  # of the probability to be blocked
_CHUNK_BYTES = 256 << 10

# The letters that are folded, and those that entropy and counts look at.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SUFFIXES = ("last_label", "last_two_labels", "file_suffix")
LEXICAL = (
    "url_length",
    "host_length",
    "path_length",
    "host_depth",
    "path_depth",
    "host_digits",
    "path_digits",
    "host_hyphens",
    "host_entropy",
    "path_entropy",
    "parameters",
    "query_length",
    "has_fragment",
)
FEATURES = LEXICAL + SUFFIXES


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, where the path begins with ``path``."""

    host: str
    path: str
    block: bool

    def __str__(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
    Empty for null and where there is no ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null and without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The text of the rule that decides, and whether it blocks; both null if none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules, got {len(rules)}")
    name, block = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    # The last branch wins: shorter rules first, allowing before blocking ones.
    for rule in sorted(rules, key=lambda r: (len(str(r)), r.block, str(r))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, block = F.when(fits, str(rule)).otherwise(name), F.when(fits, rule.block).otherwise(block)
    return name, block


# --- features --------------------------------------------------------------------------


def _counts(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How many bytes of every text are among the wanted ones."""
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(wanted[data], out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _byte_set(*chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list("".join(chars).encode())] = True
    return out


def _entropy(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits per byte of every text; 0 for empty ones."""
    lengths = np.diff(offsets)
    text = np.repeat(np.arange(len(lengths)), lengths)
    cell, n = np.unique(text * 256 + data, return_counts=True)
    share = n / lengths[cell // 256]
    return np.bincount(cell // 256, weights=-share * np.log2(share), minlength=len(lengths))


def _parts(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.r_[0, np.cumsum([len(r) for r in raw], dtype=np.int64)].astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), offsets


_DIGITS, _SLASH, _DOT = _byte_set("0123456789"), _byte_set("/"), _byte_set(".")
_HYPHEN, _AND, _HASH = _byte_set("-"), _byte_set("&"), _byte_set("#")


def lexical_features(urls: Sequence[str], hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
    """A row of `LEXICAL` per URL. Lengths are bytes; a share of nothing is 0."""
    queries = [u.partition("#")[0].partition("?")[2] for u in urls]
    url, host, path, query = map(_parts, (urls, hosts, paths, queries))
    length = {name: np.diff(p[1]) for name, p in (("url", url), ("host", host), ("path", path), ("query", query))}

    def share(part: tuple[np.ndarray, np.ndarray], n: np.ndarray) -> np.ndarray:
        return _counts(*part, _DIGITS) / np.maximum(n, 1)

    columns = [
        length["url"],
        length["host"],
        length["path"],
        np.where(length["host"] > 0, _counts(*host, _DOT) + 1, 0),
        _counts(*path, _SLASH),
        share(host, length["host"]),
        share(path, length["path"]),
        _counts(*host, _HYPHEN),
        _entropy(*host),
        _entropy(*path),
        np.where(length["query"] > 0, _counts(*query, _AND) + 1, 0),
        length["query"],
        _counts(*url, _HASH) > 0,
    ]
    return np.stack([np.asarray(c, np.float64) for c in columns], axis=1)


def suffixes_of(host: str, path: str) -> tuple[str, str, str]:
    """Last label and last two labels of the host, and what follows the last dot of the path's last part."""
    labels = host.split(".")
    name = path.rpartition("/")[2]
    return labels[-1], ".".join(labels[-2:]), name.rpartition(".")[2] if "." in name else ""


@dataclass
class SuffixRates:
    """Smoothed rates of blocked examples per suffix, one table per kind."""

    prior: float
    rates: list[dict[str, float]] = field(repr=False)

    @classmethod
    def count(cls, found: list[tuple[str, str, str]], labels: np.ndarray) -> SuffixRates:
        prior = float(labels.mean()) if len(labels) else 0.0
        tables = []
        for kind in range(len(SUFFIXES)):
            names, of = np.unique(np.array([f[kind] for f in found], object).astype(str), return_inverse=True)
            n = np.bincount(of, minlength=len(names))
            blocked = np.bincount(of, weights=labels, minlength=len(names))
            rate = (blocked + SMOOTHING * prior) / (n + SMOOTHING)
            tables.append(dict(zip(names.tolist(), rate.tolist())))
        return cls(prior, tables)

    def __call__(self, found: list[tuple[str, str, str]]) -> np.ndarray:
        out = [[table.get(f[k], self.prior) for k, table in enumerate(self.rates)] for f in found]
        return np.array(out, np.float64).reshape(len(found), len(SUFFIXES))


# --- boosted trees ---------------------------------------------------------------------


@dataclass
class Tree:
    """A complete binary tree in heap order: a feature and a threshold per inner node, a value per leaf."""

    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(DEPTH):
            right = x[rows, self.features[node]] > self.thresholds[node]
            node = 2 * node + 1 + right
        return self.leaves[node - len(self.features)]


def _grow(binned: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray) -> Tree:
    """One tree, level by level; a node that no cut improves sends all rows to the left."""
    n_features, inner = binned.shape[1], 2**DEPTH - 1
    features, thresholds = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(binned), np.int64)
    for level in range(DEPTH):
        first, width = 2**level - 1, 2**level
        best = np.full(width, 1e-9)
        choice = np.full((width, 2), -1)
        for f in range(n_features):
            cell = (node - first) * BINS + binned[:, f]
            g = np.bincount(cell, gradient, width * BINS).reshape(width, BINS).cumsum(axis=1)
            h = np.bincount(cell, hessian, width * BINS).reshape(width, BINS).cumsum(axis=1)
            gl, hl, gr, hr = g[:, :-1], h[:, :-1], g[:, -1:] - g[:, :-1], h[:, -1:] - h[:, :-1]
            gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g[:, -1:] ** 2 / (h[:, -1:] + RIDGE)
            gain[(hl < MIN_LEAF_WEIGHT) | (hr < MIN_LEAF_WEIGHT)] = 0
            gain[:, len(cuts[f]) :] = 0
            at = gain.argmax(axis=1)
            value = gain[np.arange(width), at]
            better = value > best
            best[better] = value[better]
            choice[better] = np.stack([np.full(width, f), at], axis=1)[better]
        for i, (f, at) in enumerate(choice):
            if f >= 0:
                features[first + i], thresholds[first + i] = f, cuts[f][at]
        chosen = choice[node - first]
        right = (chosen[:, 0] >= 0) & (binned[np.arange(len(binned)), chosen[:, 0]] > chosen[:, 1])
        node = 2 * node + 1 + right
    g = np.bincount(node - inner, gradient, inner + 1)
    h = np.bincount(node - inner, hessian, inner + 1)
    return Tree(features, thresholds, -RATE * g / (h + RIDGE))


@dataclass
class Model:
    """Probability to be blocked."""

    start: float
    suffixes: SuffixRates
    trees: list[Tree] = field(repr=False)

    def __call__(self, urls: Sequence[str], hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        found = [suffixes_of(h, p) for h, p in zip(hosts, paths)]
        return self.probability(np.concatenate([lexical_features(urls, hosts, paths), self.suffixes(found)], axis=1))

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for tree in self.trees:
            total += tree(x)
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, labels: np.ndarray, suffixes: SuffixRates, trees: int = TREES) -> Model:
    """Boosted trees on the feature rows ``x``; with one class only, its smoothed rate."""
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    start = float(np.log(rate / (1 - rate)))
    model = Model(start, suffixes, [])
    if not 0 < labels.sum() < len(labels):
        return model
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS, method="lower"))
        cuts.append(values[values < x[:, f].max()])
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    total = np.full(len(x), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        model.trees.append(_grow(binned, cuts, p - labels, p * (1 - p)))
        total += model.trees[-1](x)
    return model


def train(
    docs: DataFrame, rules: Sequence[Rule], url_col: str = "url", max_examples: int = MAX_EXAMPLES
) -> Model:
    """Learn from the URLs that rules decide.

    Null URLs are no examples and repeated ones count once, so hot URLs weigh as much as others.
    Without any example the rate to be blocked is one half, and every URL without a rule is blocked
    at the usual threshold; callers that want another default choose the threshold.
    """
    url = F.col(url_col)
    host, path = host_of(url), path_of(url)
    labelled = docs.select(
        url.alias("url"), host.alias("host"), path.alias("path"), rule_of(host, path, rules)[1].alias("block")
    ).where("block IS NOT NULL")
    rows = labelled.distinct().orderBy(F.xxhash64("url"), "url").limit(max_examples).collect()
    labels = np.array([r["block"] for r in rows], np.float64)
    found = [suffixes_of(r["host"], r["path"]) for r in rows]
    lexical = lexical_features(*([r[c] for r in rows] for c in ("url", "host", "path")))
    own = np.zeros((len(rows), len(SUFFIXES)))
    fold = np.arange(len(rows)) % FOLDS  # the rows stand in the order of a hash
    for k in range(FOLDS):
        others = np.flatnonzero(fold != k)
        rates = SuffixRates.count([found[i] for i in others], labels[others])
        own[fold == k] = rates([found[i] for i in np.flatnonzero(fold == k)])
    return boost(np.concatenate([lexical, own], axis=1), labels, SuffixRates.count(found, labels))


def judge(
    docs: DataFrame,
    rules: Sequence[Rule],
    model: Model,
    url_col: str = "url",
    threshold: float = THRESHOLD,
    prefix: str = "",
) -> DataFrame:
    """``docs`` with host, path, rule, verdict (allow or block) and score of every URL appended.

    The score is the trees' probability to be blocked, also where a rule decides. Columns of
    ``docs`` that have the name of a new one are replaced; ``prefix`` keeps them apart. A null or
    empty URL and one without ``://`` has an empty host and path, fits no rule and is judged by its
    features like any other; repeated rows stay, equal URLs have equal verdicts, and an empty table
    gives none. URLs of any length are read whole. Nothing is shuffled.
    """
    names = [prefix + n for n in ("host", "path", "rule", "verdict", "score")]
    taken = {n.lower() for n in names}
    passed = [c for c in docs.columns if c.lower() not in taken]
    url = F.col(f"`{url_col}`")
    host, path = host_of(url), path_of(url)
    rule, block = rule_of(host, path, rules)
    work = ["_url_text", "_url_host", "_url_path", "_url_rule", "_url_block"]
    ruled = docs.select(
        *[F.col(f"`{c}`") for c in passed],
        *[c.alias(n) for c, n in zip((F.coalesce(url, F.lit("")), host, path, rule, block), work)],
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = shared.value
        for batch in batches:
            texts = column(batch, "_url_text")
            scores = [np.zeros(0)]
            for row, end, _, _ in text_chunks(texts, _CHUNK_BYTES):
                part = [column(batch, c).slice(row, end - row).to_pylist() for c in work[:3]]
                scores.append(fitted(*part))
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c) for c in kept), pa.array(np.concatenate(scores))], names=[*kept, "_url_score"]
            )

    kept = [*passed, *work[1:]]
    schema = T.StructType([ruled.schema[c] for c in kept] + [T.StructField("_url_score", T.DoubleType())])
    scored = ruled.mapInArrow(run, schema)
    blocked = F.coalesce("_url_block", F.col("_url_score") >= threshold)
    verdict = F.when(blocked, "block").otherwise("allow")
    found = [F.col("_url_host"), F.col("_url_path"), F.col("_url_rule"), verdict, F.col("_url_score")]
    return scored.select(*[F.col(f"`{c}`") for c in passed], *[c.alias(n) for c, n in zip(found, names)])
