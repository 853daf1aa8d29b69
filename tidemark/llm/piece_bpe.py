"""SentencePiece encoding and decoding by vectorised merge rounds.

A text is prefixed with the space symbol, spaces become that symbol, and the text falls into
units: a run of space symbols with what follows it. No piece of such a vocabulary has a space
symbol after another character (checked when the model is loaded), so no merge crosses two
units, and every different unit of a chunk is encoded once.

One round looks up every neighbouring pair of symbols, takes each unit's best-ranked pair,
merges its occurrences from the left at the same time, and compacts the arrays; units without
a pair leave the rounds. Where a merge can create a pair of the same or a better rank, only
the leftmost occurrence is merged in that round, as one-by-one merging would do it. Units of text
without spaces are cut between characters that stand side by side in no piece, which no merge
crosses either. What is still longer than `LONG_UNIT` symbols (thousands of letters without a
space) is merged one by one with a heap, in n log n steps: rounds of such a unit would take a pass
over it for every rank.

The normaliser of the model must be the identity with a dummy prefix. Only the pieces and
their scores are read from the model file; its path is a parameter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import binary, column, ragged, span_hashes, text_chunks

SPACE = "▁"
_SPACE_CODE = ord(SPACE)
LONG_UNIT = 4096
_CUT_UNIT = 64  # shorter units are not looked at for places to cut
_CHUNK_BYTES = 1 << 20  # of text at a time; the arrays take some dozens of times as much
_NEVER = np.iinfo(np.int32).max
_SLOT_BITS = 18


class Pieces:
    """The tables of one model: characters, pairs, ranks and the bytes of every id."""

    def __init__(self, model_path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        probe = " a  ﬁ\u0041\u030a\u00a0\u3000\uff21\t\n "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model's normaliser changes texts")
        size = model.vocab_size()
        self.begin, self.end = model.bos_id(), model.eos_id()
        pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("a piece has a space symbol after another character")
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

        self.of_char = np.full(0x110000, -1, np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        scores = np.array([model.get_score(i) for i in range(size)])
        _, rank = np.unique(-scores, return_inverse=True)
        self.rank = rank.astype(np.int32)
        self.size = size

        pairs = [
            (ids[p[:k]] * size + ids[p[k:]], i)
            for p, i in ids.items()
            for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids
        ]
        pairs.sort()
        self.pairs = dict(pairs)
        beside = {ord(a) << 21 | ord(b) for p in ids for a, b in zip(p, p[1:])}
        self.beside = np.array(sorted(beside), np.int64)
        self.levels = _hash_levels(self.pairs)
        # One by one: pieces that take part in a merge ranked as well as their own or better,
        # and pieces that share their rank.
        self.one_by_one = np.bincount(self.rank, minlength=size)[self.rank] > 1
        for key, merged in pairs:
            for part in divmod(key, size):
                if self.rank[merged] <= self.rank[part]:
                    self.one_by_one[part] = True

        raw = []
        for i, piece in enumerate(pieces):
            if model.is_byte(i):
                raw.append(bytes([int(piece[3:5], 16)]))
            elif special[i]:
                raw.append(b"")
            else:
                raw.append(piece.replace(SPACE, " ").encode())
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_length = np.array([len(r) for r in raw])
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length

    # --- merging -----------------------------------------------------------------------

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of every pair, -1 where there is none."""
        keys = np.where((left >= 0) & (right >= 0), left * self.size + right, -2)
        merged = np.full(len(keys), -1, np.int32)
        open_ = None
        for factor, level_keys, level_ids in self.levels:
            slot = _slots(keys, factor)
            stored = level_keys[slot]
            found = stored == keys
            if open_ is None:
                merged[found] = level_ids[slot[found]]
                open_ = np.flatnonzero(~found & (stored >= 0))
            else:
                merged[open_[found]] = level_ids[slot[found]]
                open_ = open_[~found & (stored >= 0)]
            if not len(open_):
                break
            keys = keys[~found & (stored >= 0)]
        return merged

    def merge(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every unit; returns all symbols in unit order and the new lengths."""
        done_symbols, done_units = [], []
        long = np.flatnonzero(lengths > LONG_UNIT)
        for u in long:
            merged = self._merge_one(symbols[starts[u] : starts[u] + lengths[u]].tolist())
            done_symbols.append(np.array(merged, np.int64))
            done_units.append(np.full(len(merged), u))
        short = np.flatnonzero(lengths <= LONG_UNIT)
        unit = np.repeat(short, lengths[short])
        current = symbols[ragged(starts[short], lengths[short])].astype(np.int64)
        merged = np.full(len(current), -1, np.int32)
        if len(current):
            merged[:-1] = self._pairs(current[:-1], current[1:])
            merged[:-1][unit[1:] != unit[:-1]] = -1
        while len(current):
            rank = np.where(merged >= 0, self.rank[merged], _NEVER)
            begins = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            sizes = np.diff(np.r_[begins, len(unit)])
            best = np.repeat(np.minimum.reduceat(rank, begins), sizes)
            finished = best == _NEVER
            if finished.any():
                done_symbols.append(current[finished])
                done_units.append(unit[finished])
                open_ = ~finished
                current, unit, merged, rank, best = (x[open_] for x in (current, unit, merged, rank, best))
                if not len(current):
                    break
            hit = rank == best
            position = np.arange(len(hit))
            begun = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], position, 0))
            hit &= (position - begun) % 2 == 0
            careful = hit & self.one_by_one[merged]
            if careful.any():
                hits = np.flatnonzero(hit)
                first = np.r_[True, unit[hits[1:]] != unit[hits[:-1]]]
                hit[hits[~first & careful[hits]]] = False
            current = np.where(hit, merged, current)
            keep = ~np.r_[False, hit[:-1]]
            changed = np.cumsum(keep)[hit] - 1
            current, unit, merged = current[keep], unit[keep], merged[keep]
            # Only the pairs beside a merged symbol are new.
            last = len(current) - 1
            left = np.r_[changed[changed < last], changed[changed > 0] - 1]
            merged[changed] = -1
            new = self._pairs(current[left], current[left + 1])
            merged[left] = np.where(unit[left] == unit[left + 1], new, -1)
        out_units = np.concatenate(done_units) if done_units else np.zeros(0, np.int64)
        out = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
        order = np.argsort(out_units, kind="stable")
        return out[order], np.bincount(out_units, minlength=len(lengths))

    def _merge_one(self, symbols: list[int]) -> list[int]:
        """The same result for one unit, pair by pair: best rank first, leftmost of equals."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            if i < 0 or after[i] >= n or symbols[i] < 0 or symbols[after[i]] < 0:
                return
            merged = pairs.get(symbols[i] * self.size + symbols[after[i]])
            if merged is not None:
                heapq.heappush(heap, (int(self.rank[merged]), i, symbols[i], symbols[after[i]], merged))

        alive = [True] * n
        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i] = merged
            alive[j] = False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [s for s, a in zip(symbols, alive) if a]

    # --- texts -------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts without begin and end ids, and the number per text."""
        counts = np.zeros(len(texts), np.int64)
        filled = [k for k, t in enumerate(texts) if t]
        if not filled:
            return np.zeros(0, np.int64), counts
        joined = "".join(SPACE + texts[k] for k in filled)
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.int64)
        codes[codes == 0x20] = _SPACE_CODE
        sizes = np.array([len(texts[k]) + 1 for k in filled])
        text_starts = np.cumsum(sizes) - sizes
        space = codes == _SPACE_CODE
        first = space & ~np.r_[False, space[:-1]]
        first[text_starts] = True
        starts = self._cut(codes, np.flatnonzero(first))
        ends = np.r_[starts[1:], len(codes)]
        _, chosen, which = np.unique(span_hashes(codes, starts, ends), return_index=True, return_inverse=True)
        # Hashes only suggest that units are equal; their letters decide.
        twin, lengths = starts[chosen][which], ends - starts
        if (lengths != lengths[chosen][which]).any() or (codes != codes[ragged(twin, lengths)]).any():
            chosen = which = np.arange(len(starts))

        symbols = self.of_char[codes].astype(np.int64)
        symbols = np.where(symbols >= 0, symbols, -1 - codes)
        ids, lengths = self.merge(symbols, starts[chosen], (ends - starts)[chosen])
        ids, lengths = self._fall_back(ids, lengths)
        unit_starts = np.cumsum(lengths) - lengths
        flat = ids[ragged(unit_starts[which], lengths[which])]
        unit_text = np.searchsorted(text_starts, starts, side="right") - 1
        counts[filled] = np.bincount(unit_text, weights=lengths[which], minlength=len(filled)).astype(np.int64)
        return flat, counts

    def _cut(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The first places of units, with long ones cut where two characters never share a piece."""
        lengths = np.diff(np.r_[starts, len(codes)])
        long = lengths > _CUT_UNIT
        if not long.any() or not len(self.beside):
            return starts
        place = ragged(starts[long] + 1, lengths[long] - 1)
        pair = codes[place - 1] << 21 | codes[place]
        at = np.minimum(np.searchsorted(self.beside, pair), len(self.beside) - 1)
        return np.sort(np.r_[starts, place[self.beside[at] != pair]])

    def _fall_back(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the ids of their bytes."""
        unknown = np.flatnonzero(ids < 0)
        if not len(unknown):
            return ids, lengths
        unit = np.repeat(np.arange(len(lengths)), lengths)
        spelled = {c: self.byte_ids[list(chr(c).encode())] for c in set((-1 - ids[unknown]).tolist())}
        width = np.ones(len(ids), np.int64)
        width[unknown] = [len(spelled[c]) for c in (-1 - ids[unknown]).tolist()]
        begin = np.cumsum(width) - width
        out = np.empty(int(width.sum()), np.int64)
        out[begin] = ids
        for i in unknown:
            out[begin[i] : begin[i] + width[i]] = spelled[-1 - int(ids[i])]
        return out, np.bincount(unit, weights=width, minlength=len(lengths)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts and their offsets, for the ids of ``encode``.

        The dummy prefix, the first space of a text, is taken off again.
        """
        lengths = self.raw_length[ids]
        data = self.raw[ragged(self.raw_start[ids], lengths)]
        ends = np.cumsum(np.r_[0, lengths])[np.cumsum(np.r_[0, counts])]
        drop = ends[:-1][counts > 0]
        keep = np.ones(len(data), bool)
        keep[drop[data[drop] == 0x20]] = False
        return data[keep], np.cumsum(np.r_[0, keep])[ends]


def _slots(keys: np.ndarray, factor: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(factor)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def _hash_levels(pairs: dict[int, int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Hash tables with one key per slot; what collides in one table goes to the next."""
    keys, ids = np.array([*pairs], np.int64), np.array([*pairs.values()], np.int32)
    levels = []
    factor = 0x9E3779B97F4A7C15
    while len(keys) or not levels:
        level_keys, level_ids = np.full(1 << _SLOT_BITS, -1, np.int64), np.zeros(1 << _SLOT_BITS, np.int32)
        slot = _slots(keys, factor)
        level_keys[slot], level_ids[slot] = keys, ids
        left = level_keys[slot] != keys
        levels.append((factor, level_keys, level_ids))
        keys, ids, factor = keys[left], ids[left], (factor * 0xD1342543DE82EF95) % (1 << 64) | 1
    return levels


@lru_cache(maxsize=2)
def pieces(model_path: str) -> Pieces:
    return Pieces(model_path)


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, decoded)`` of every row: ids with begin and end id, and their decoded text.

    ``ids`` holds little-endian unsigned 32-bit numbers. A null or empty text has begin and end
    id alone and decodes to the empty string. Repeated rows and repeated or null ids give a row
    each; other columns are left out, whatever their names; no rows give no rows.
    """
    narrow = docs.select(F.col(id_col), F.col(text_col))
    schema = f"`{id_col}` {narrow.schema[0].dataType.simpleString()}, ids binary, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(model_path)
        for batch in batches:
            texts = column(batch, text_col)
            for row, end, _, _ in text_chunks(texts, _CHUNK_BYTES):
                flat, counts = table.encode(texts.slice(row, end - row).fill_null("").to_pylist())
                decoded, offsets = table.decode(flat, counts)
                bounds = np.cumsum(np.r_[0, counts + 2])
                framed = np.empty(int(bounds[-1]), "<u4")
                framed[bounds[:-1]] = table.begin
                framed[bounds[1:] - 1] = table.end
                inner = np.ones(len(framed), bool)
                inner[bounds[:-1]] = inner[bounds[1:] - 1] = False
                framed[inner] = flat
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, id_col).slice(row, end - row),
                        binary(framed.view(np.uint8), bounds * 4, pa.binary()),
                        binary(decoded, offsets, pa.large_binary()).cast(pa.large_string()).cast(pa.string()),
                    ],
                    names=[id_col, "ids", "decoded"],
                )

    return narrow.mapInArrow(run, schema)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Numbers of tokens, and SHA-256 of ids and decoded text."""
    return encoded.select(
        F.col(id_col),
        F.expr("CAST(length(ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
