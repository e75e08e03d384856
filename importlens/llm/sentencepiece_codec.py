"""SentencePiece encoding and decoding with a batched numpy Viterbi pass.

A text is cut into units that no piece crosses (a run of spaces with the
following characters that occur in longer pieces; every other character alone).
Units that a worker has not met before are grouped by length, and the units of a
group advance together, one character at a time: prefix hashes give the hash of
every substring, which probes the sorted piece keys of that length (if any starts with the same bits), and
vectorised maxima over the pieces that end at a position store backpointers.

The file's model type says what a best path is:

* unigram: the largest sum of piece scores; a character without a piece costs
  the lowest score less ten;
* BPE (the type of the public 32k file): scores are merge ranks and do not add
  up, so the plain sum gives other ids than the model defines. Every prefix of a
  unit has one last piece in its merge result, namely the one that is consistent
  with the last piece before it: undoing the two pieces' merges step by step
  never shows a merge across their border that would have come first. Each pass
  takes the consistent piece, longest first. The consistency of piece pairs is
  kept in a fixed-size table, and every path is checked against its unit.

Only the vocabulary file is read; nothing is trained. Its path is a parameter.
Supported are models without text normalisation rules other than white space.

Defined results: a null text gives null ids; an empty text no ids. Characters
without a piece become their UTF-8 bytes where the vocabulary has byte pieces,
else one unknown id per run. Decoding restores the text exactly, but for the
word-boundary mark U+2581, which comes back as a space. Repeated rows give
repeated results; extra columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import chain, compress
from typing import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from importlens.llm.common import arrow_pass, table

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
UNIGRAM, BPE = 1, 2
UNKNOWN_COST = 10.0
#: Units kept by a worker, pair verdicts kept by a worker (a power of two), units in one numpy pass.
KEPT_UNITS, KEPT_PAIRS, PASS_UNITS = 150_000, 1 << 19, 4096
#: Leading bits of a hash by which most substrings are known to be no piece.
START_BITS = 18
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
NONE = np.int64(1) << 40


def _message(data: bytes) -> list[tuple[int, object]]:
    """Fields of a protocol buffer message."""
    at, out = 0, []

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            out.append((key >> 3, number()))
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            out.append((key >> 3, data[at:at + size]))
            at += size
    return out


@dataclass
class Vocabulary:
    """What a SentencePiece file says, as arrays."""

    pieces: list[str]          # by id, with spaces for the mark
    scores: np.ndarray         # by id
    normal: np.ndarray         # by id: an ordinary piece
    byte_ids: list[int]        # ids of the 256 byte pieces, or empty
    unknown_id: int
    kind: int
    dummy_prefix: bool
    collapse_spaces: bool
    split: np.ndarray = field(default=None)   # by id: the two pieces whose merge gives it (itself: none)

    @classmethod
    def read(cls, path: str = MODEL_PATH, kind: int | None = None) -> "Vocabulary":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        top = _message(model.serialized_model_proto())
        specs = {f: dict(_message(v)) for f, v in top if f in (2, 3)}
        rules = specs.get(3, {})
        if rules.get(2):
            raise ValueError("models with character normalisation rules are not supported")
        kind = kind or specs.get(2, {}).get(3, UNIGRAM)
        if kind not in (UNIGRAM, BPE):
            raise ValueError("the model must be a unigram or a BPE model")
        normal = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in ids]
        byte_ids = [i for i in ids if model.is_byte(i)]
        out = cls([model.id_to_piece(i).replace("▁", " ") for i in ids],
                  np.array([model.get_score(i) for i in ids]), np.array(normal),
                  sorted(byte_ids, key=lambda i: int(model.id_to_piece(i)[1:-1], 16)), model.unk_id(), kind,
                  bool(rules.get(3, 1)), bool(rules.get(4, 1)))
        if kind == BPE:
            out._learn_splits()
        return out

    def _learn_splits(self) -> None:
        """For each piece, the last merge of its own characters; pieces that merging never yields are dropped."""
        rank = {p: (-s, i) for i, (p, s, n) in enumerate(zip(self.pieces, self.scores.tolist(), self.normal)) if n}
        self.split = np.stack([np.arange(len(self.pieces))] * 2, axis=1)
        for i, piece in enumerate(self.pieces):
            if self.normal[i] and len(piece) > 1:
                parts = merge(piece, rank, until=2)
                if len(parts) == 2 and all(p in rank for p in parts) and rank[piece] > max(
                        (rank[p] for p in parts if len(p) > 1), default=(-np.inf, 0)):
                    self.split[i] = rank[parts[0]][1], rank[parts[1]][1]
                else:
                    self.normal[i] = False


def merge(unit: str, rank: dict, until: int = 1) -> list[str]:
    """Plain merging: the adjacent pair whose union ranks first is joined, again and again."""
    parts = list(unit)
    while len(parts) > until:
        best, at = min(((rank.get(a + b, (np.inf, 0)), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
        if best[0] == np.inf:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Codec:
    """Encoder and decoder of one vocabulary; keeps what it has met, within fixed bounds."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        own = [i for i in range(len(v.pieces)) if v.normal[i]]
        joined = sorted({c for i in own if len(v.pieces[i]) > 1 for c in v.pieces[i]} - {" "})
        inner = any(" " in v.pieces[i].lstrip(" ") for i in own)  # pieces that cross words: no unit ends at a space
        letters = "".join(map(re.escape, joined)) or "▁"
        self.units = re.compile(rf"[ {letters}]+|." if inner else rf" *[{letters}]+| +|.", re.S)
        self.order = self._ordered(own)
        self.rank_of = {v.pieces[i]: (-v.scores[i], i) for i in own}
        self.longest = max(map(len, (v.pieces[i] for i in own)), default=1)
        self.powers = np.ones(self.longest + 1, dtype=np.uint64)
        for n in range(self.longest):
            self.powers[n + 1:] *= BASE     # modulo 2 ** 64
        self.keys, self.values, self.starts = [None], [None], [None]
        for n in range(1, self.longest + 1):
            found = [i for i in own if len(v.pieces[i]) == n]
            hashes = self._hashes(np.array([[ord(c) for c in v.pieces[i]] for i in found], dtype=np.uint64).reshape(-1, n))[:, -1]
            by = np.argsort(hashes)
            self.keys.append(hashes[by])
            self.values.append(np.array([self.order[i] for i in found], dtype=np.int64)[by])
            self.starts.append(np.zeros(1 << START_BITS, dtype=bool))
            self.starts[n][self.keys[n] >> np.uint64(64 - START_BITS)] = True
        self._forget()
        spelled = [p.encode() for p in v.pieces]
        for byte, i in enumerate(v.byte_ids):
            spelled[i] = bytes([byte])
        spelled[v.unknown_id] = " ⁇ ".encode()
        self.spelled = pa.array(spelled, pa.large_binary())

    def _forget(self) -> None:
        """No unit is known; a known unit has a number, by which its ids are found in ``flat``."""
        self.met: dict[str, int] = {}
        self.flat, self.size = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        self.begin = self.size

    def _ordered(self, own: list[int]) -> np.ndarray:
        """Piece ids become places: 0 unknown, then single characters, then longer pieces in the order of merging."""
        v = self.v
        place = np.zeros(len(v.pieces), dtype=np.int64)
        self.ids = sorted(own, key=lambda i: (len(v.pieces[i]) > 1, -v.scores[i], i))
        place[self.ids] = np.arange(1, len(self.ids) + 1)
        self.ids = np.array([v.unknown_id, *self.ids], dtype=np.int64)
        self.score = v.scores[self.ids]
        self.score[0] = (v.scores[own].min() if own else 0.0) - UNKNOWN_COST
        if v.kind == BPE:
            halves = place[v.split[self.ids]]
            halves[0] = 0
            self.left, self.right = halves[:, 0].copy(), halves[:, 1].copy()
            made = np.flatnonzero(self.left != np.arange(len(self.ids)))
            keys = self.left[made] * len(self.ids) + self.right[made]
            by = np.argsort(keys)
            self.pair_keys, self.pair_makes = np.append(keys[by], NONE), np.append(made[by], NONE)
            self.pair_starts = np.zeros(1 << START_BITS, dtype=bool)
            self.pair_starts[self._start(keys)] = True
            self.seen_pairs = np.full(KEPT_PAIRS, -1, dtype=np.int64)
            self.seen_verdicts = np.zeros(KEPT_PAIRS, dtype=bool)
        return place

    def _hashes(self, codes: np.ndarray) -> np.ndarray:
        """Hashes of all prefixes, the empty one first."""
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), dtype=np.uint64)
        for j in range(codes.shape[1]):
            out[:, j + 1] = out[:, j] * BASE + codes[:, j] + np.uint64(1)
        return out

    def _consistent(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging leaves the border between the two pieces of each pair alone."""
        keys = first * len(self.ids) + second
        slot = (keys.astype(np.uint64) * BASE >> np.uint64(64 - KEPT_PAIRS.bit_length() + 1)).astype(np.int64)
        out = self.seen_verdicts[slot]
        new = np.flatnonzero(self.seen_pairs[slot] != keys)
        if len(new):
            out[new] = self._undo(first[new], second[new])
            self.seen_pairs[slot[new]], self.seen_verdicts[slot[new]] = keys[new], out[new]
            # two new pairs may share a slot: keep the verdict that belongs to the stored pair
            lost = new[self.seen_pairs[slot[new]] != keys[new]]
            self.seen_pairs[slot[lost]] = -1
        return out

    @staticmethod
    def _start(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * BASE) >> np.uint64(64 - START_BITS)

    def _undo(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        verdict, limit = np.zeros(len(a), dtype=bool), np.full(len(a), NONE)
        rows = np.arange(len(a))
        while len(rows):
            keys = a * len(self.ids) + b
            some = np.flatnonzero(self.pair_starts[self._start(keys)])
            at = np.searchsorted(self.pair_keys, keys[some])
            makes = np.full(len(keys), NONE)
            makes[some] = np.where(self.pair_keys[at] == keys[some], self.pair_makes[at], NONE)
            going = makes >= limit
            a, b, limit, rows = a[going], b[going], limit[going], rows[going]
            plain_a, plain_b = self.right[a] == a, self.left[b] == b
            verdict[rows[plain_a & plain_b]] = True
            more = ~(plain_a & plain_b)
            a, b, limit, rows, plain_a, plain_b = a[more], b[more], limit[more], rows[more], plain_a[more], plain_b[more]
            cut = np.where(a > b, ~plain_a, plain_b)
            limit = np.where(cut, a, b + 1)
            a, b = np.where(cut, self.right[a], a), np.where(cut, b, self.left[b])
        return verdict

    def _places(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best path of each row of equal-length units, as right-aligned places and their numbers."""
        n, size = codes.shape
        hashes, probes = self._hashes(codes), [None]
        for width in range(1, min(size, self.longest) + 1):
            wanted = hashes[:, width:] - hashes[:, :-width] * self.powers[width]
            keys, values = self.keys[width], self.values[width]
            if len(keys):
                found, flat = np.full(wanted.size, -1), wanted.reshape(-1)
                some = np.flatnonzero(self.starts[width][flat >> np.uint64(64 - START_BITS)])     # most hashes start like no key
                at = np.minimum(np.searchsorted(keys, flat[some]), len(keys) - 1)
                found[some] = np.where(keys[at] == flat[some], values[at], -1)
                probes.append(found.reshape(wanted.shape))
            else:
                probes.append(np.full(wanted.shape, -1))
        probes[1] = np.maximum(probes[1], 0)     # the unknown place
        last, step = np.zeros((n, size + 1), dtype=np.int64), np.zeros((n, size + 1), dtype=np.int64)
        total = np.full((n, size + 1), -np.inf)
        total[:, 0] = 0
        for end in range(1, size + 1):
            for width in range(min(end, self.longest), 0, -1):
                piece, start = probes[width][:, end - width], end - width
                if self.v.kind == BPE:
                    rows = np.flatnonzero((piece >= 0) & (step[:, end] == 0))
                    if start and len(rows):
                        rows = rows[self._consistent(last[rows, start], piece[rows])]
                else:
                    value = np.where(piece >= 0, total[:, start] + self.score[piece], -np.inf)
                    rows = np.flatnonzero(value > total[:, end])
                    total[rows, end] = value[rows]
                last[rows, end], step[rows, end] = piece[rows], width
        return self._followed(last, step, size)

    @staticmethod
    def _followed(last: np.ndarray, step: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Follow all backpointers at once: places, right-aligned in rows, and their numbers."""
        rows, at, columns = np.arange(len(last)), np.full(len(last), size), []
        count = np.zeros(len(last), dtype=np.int64)
        while at.any():
            columns.append(last[rows, at])
            count += at > 0
            back = step[rows, at]
            if (back[at > 0] == 0).any():
                raise ArithmeticError("no path spells a unit")
            at = at - back
        return np.stack(columns[::-1], axis=1), count

    def _learn(self, units: list[str]) -> None:
        by_size: dict[int, list[str]] = {}
        made, sizes = [self.flat], [self.size]
        for u in units:
            by_size.setdefault(len(u), []).append(u)
        piece = self.v.pieces.__getitem__
        for size, group in by_size.items():
            for at in range(0, len(group), PASS_UNITS):
                some = group[at:at + PASS_UNITS]
                raw = "".join(some).encode("utf-32-le", "surrogatepass")
                codes = np.frombuffer(raw, dtype="<u4").reshape(len(some), size).astype(np.uint64)
                places, count = self._places(codes)
                used = np.arange(places.shape[1])[None, :] >= places.shape[1] - count[:, None]
                strange = ((places == 0) & used).any(axis=1)
                plain, ids = ~strange, self.ids[places]
                spelled = "".join(map(piece, ids[plain][used[plain]].tolist()))
                if spelled != "".join(compress(some, plain.tolist())):   # a hash that two strings share
                    raise ArithmeticError(f"the pieces do not spell the units of {size} characters")
                flat = ids[used]
                if strange.any():
                    ends = np.cumsum(count).tolist()
                    rows = [flat[end - n:end].tolist() for end, n in zip(ends, count.tolist())]
                    rows = [self._with_unknown(u, row) if odd else row for u, row, odd in zip(some, rows, strange.tolist())]
                    flat, count = np.array(list(chain.from_iterable(rows))), np.array([len(row) for row in rows])
                self.met.update(zip(some, range(len(self.met), len(self.met) + len(some))))
                made.append(flat.astype(np.int32))
                sizes.append(count)
        self.flat, self.size = np.concatenate(made), np.concatenate(sizes)
        self.begin = np.cumsum(self.size) - self.size

    def _ids(self, units: list[str]) -> np.ndarray:
        rows = np.fromiter(map(self.met.__getitem__, units), dtype=np.int64, count=len(units))
        sizes = self.size[rows]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.begin[rows] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]

    def _with_unknown(self, unit: str, ids: list[int]) -> list[int]:
        """Unknown characters as their bytes' ids, or one id a run."""
        at, out = 0, []
        for i in ids:
            known = i != self.v.unknown_id
            piece = self.v.pieces[i] if known else unit[at]
            if known:
                out.append(i)
            elif self.v.byte_ids:
                out += [self.v.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != i:
                out.append(i)
            at += len(piece)
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        cut = [None if t is None else self.units.findall(self._prepared(t)) for t in texts]
        if len(self.met) > KEPT_UNITS:
            self._forget()
        new = {u for units in cut if units for u in units if u not in self.met}
        self._learn(list(new))
        out = [None if units is None else self._ids(units) for units in cut]
        if not self.v.byte_ids:   # a run of unknown characters is one id
            out = [x if x is None else x[np.r_[True, (x[1:] != self.v.unknown_id) | (x[:-1] != self.v.unknown_id)][:len(x)]]
                   for x in out]
        return out

    def _prepared(self, text: str) -> str:
        text = text.replace("▁", " ")
        if self.v.collapse_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        return " " + text if text and self.v.dummy_prefix else text

    def decode(self, ids: list) -> str:
        return self.decode_rows(pa.array([ids], pa.list_(pa.int32())))[0]

    def decode_rows(self, rows: pa.ListArray) -> list[str | None]:
        """Texts of rows of ids: one gather of the pieces' bytes for all rows, cut at the rows' ends."""
        spelled = self.spelled.take(rows.flatten())
        ends = np.frombuffer(spelled.buffers()[1], dtype=np.int64)[spelled.offset:] if len(spelled) else np.zeros(1, np.int64)
        cuts = ends[np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy())]].tolist()
        raw = memoryview(spelled.buffers()[2] or b"")
        out = []
        for known, start, end in zip(rows.is_valid().to_pylist(), cuts, cuts[1:]):
            text = str(raw[start:end], "utf-8", "replace")
            text = text[1:] if self.v.dummy_prefix and text.startswith(" ") else text
            out.append(text if known else None)
        return out


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """One codec per worker and broadcast vocabulary, so that units already met stay known."""
    if shared.key not in _CODECS:
        _CODECS.clear()
        _CODECS[shared.key] = Codec(shared.vocabulary.value)
    return _CODECS[shared.key]


class _Shared:
    def __init__(self, spark: SparkSession, vocabulary: Vocabulary):
        self.vocabulary = spark.sparkContext.broadcast(vocabulary)   # a fixed size, whatever the input
        self.key = id(self)


def _added(docs: DataFrame, name: str, kind: T.DataType, make: Callable[[pa.Array], pa.Array], source: str) -> DataFrame:
    """``docs`` with column ``name`` (replacing one of that name) made from ``source``."""
    kept = [f for f in docs.schema.fields if f.name != name]
    schema = T.StructType([*kept, T.StructField(name, kind)])
    columns = [f.name for f in kept]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = make(batch[source])
        return pa.RecordBatch.from_arrays([*[batch[c] for c in columns], made], [*columns, name])

    return arrow_pass(docs, step, schema)


def _ragged(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if r is None else len(r) for r in rows], dtype=np.int64)
    flat = np.concatenate([r for r in rows if r is not None] or [np.zeros(0, dtype=np.int32)])
    ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    missing = pa.array([r is None for r in rows])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)), mask=missing)


def encode(docs: DataFrame, vocabulary: Vocabulary, column: str = "text", name: str = "token_ids") -> DataFrame:
    """``docs`` with the piece ids of ``column``."""
    shared = _Shared(docs.sparkSession, vocabulary)
    return _added(docs, name, T.ArrayType(T.IntegerType()), lambda x: _ragged(_codec(shared).encode(x.to_pylist())), column)


def decode(docs: DataFrame, vocabulary: Vocabulary, column: str = "token_ids", name: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids of ``column`` spell."""
    shared = _Shared(docs.sparkSession, vocabulary)

    def make(rows: pa.ListArray) -> pa.Array:
        return pa.array(_codec(shared).decode_rows(rows), pa.string())

    return _added(docs, name, T.StringType(), make, column)


def encoded(docs: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """Rows ``(doc_id, n_tokens, token_ids, round_trip)``; the text is decoded again and compared."""
    vocabulary = Vocabulary.read(path)
    tokens = encode(docs.select("doc_id", F.col("text").cast("string")), vocabulary)
    texts = decode(tokens, vocabulary)
    same = F.col("decoded").eqNullSafe(F.translate("text", "▁", " "))
    return texts.select("doc_id", F.coalesce(F.size("token_ids"), F.lit(0)).alias("n_tokens"), "token_ids",
                        same.alias("round_trip"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return encoded(table(spark, sf_dir, "documents"))
