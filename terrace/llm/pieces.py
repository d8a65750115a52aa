"""Sampled piece encoding and lossless decoding (operator 1).

Forward-filtering backward-sampling over the piece lattice: every segment
(a word with its leading space mark, a run after a line feed, or a run from
a full stop or comma that follows a letter: no piece joins these) has a
lattice of all vocabulary pieces that fit it.  The forward pass sums, per
position, the weight of all paths to it; sampling walks back from the end
and picks each incoming piece by its share of that sum, which draws whole
segmentations in proportion to their weight.  No piece spans two segments,
so sampling segments one by one samples the text.

Weights: the vocabulary file ranks its pieces; a piece of rank r weighs
1 / (r + ``RANK_OFFSET``) ** ``theta``, a Zipf law.  Characters without a
piece fall back to their UTF-8 bytes.

Random numbers are a hash of (seed, row key, segment number, step), so a
row's sample does not depend on partitions, batches or retries.

A worker keeps the forward results of the segments it has met in one flat
table of transitions (emptied when it passes ``CACHE_ARCS``), and walks back
all segments of a batch at once, one array operation per step.

Defined cases: null text has null ids and decodes to null; empty text has
no ids; a null row key is hashed as ``null``; rows with equal keys draw the
same numbers; an empty table gives an empty result; other columns are not
read.  The space mark itself, when it occurs in a text, is encoded as bytes,
so decoding gives it back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.llm.common import key_text, prepare, table

MODEL = "piece_bpe_32k.model"
SEED = "pieces-1"
THETA = 1.0
RANK_OFFSET = 3.0
CACHE_ARCS = 6_000_000
MARK = "▁"              # the space mark of the vocabulary
MASK = "\ud800"             # stands for the mark where it is text; no valid text holds it
SPLIT = "\n\n"             # stands before a full stop or comma cut off its word (a segment holds one line feed)
UNUSED = -1e8                # pieces scored below take no part


class Pieces:
    """The vocabulary: weights of pieces, byte pieces, and every piece's bytes."""

    def __init__(self, path: str, theta: float = THETA):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = sp.get_piece_size()
        self.byte_id = np.zeros(256, np.int32)
        self.weights: dict[str, tuple[float, int]] = {}
        raw = []
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[1:-1], 16)] = i
                raw.append(bytes([int(p[1:-1], 16)]))
                continue
            if sp.is_control(i) or sp.is_unknown(i):
                raw.append(b"")
                continue
            raw.append(p.replace(MARK, " ").encode())
            if sp.get_score(i) > UNUSED or p == MARK:
                rank = -sp.get_score(i) if p != MARK else n
                self.weights[p] = (-theta * float(np.log(RANK_OFFSET + rank)), i)
        # Bytes of every piece; then the same without a leading space, for a text's first piece.
        self.raw = pa.array(raw + [r[1:] if r[:1] == b" " else r for r in raw], pa.binary())
        self._index()

    def _index(self) -> None:
        """Hashes of all pieces and their prefixes, sorted, with log weight and id (a mere prefix: id -1)."""
        self.longest = max(map(len, self.weights))
        found: dict[str, tuple[float, int]] = {p[:k]: (0.0, -1) for p in self.weights for k in range(1, len(p))}
        found.update(self.weights)
        texts = list(found)
        h = np.zeros(len(texts), np.uint64)
        lens = np.array([len(t) for t in texts])
        codes = np.zeros((len(texts), self.longest), np.uint64)
        for r, t in enumerate(texts):
            codes[r, :len(t)] = [ord(c) for c in t]
        for k in range(self.longest):
            live = lens > k
            h[live] = extended(h[live], codes[live, k])
        order = np.argsort(h)
        self.hashes = h[order]
        if len(np.unique(h)) != len(h):
            raise AssertionError("two pieces share a hash")
        self.log_weight = np.array([found[t][0] for t in texts])[order]
        self.id = np.array([found[t][1] for t in texts], np.int32)[order]


def extended(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The hash of a string with one more character."""
    x = (h + code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Sampler:
    """Forward tables of the segments met, and backward sampling of a batch."""

    def __init__(self, pieces: Pieces, cache_arcs: int = CACHE_ARCS):
        self.pieces, self.cache_arcs = pieces, cache_arcs
        self._empty()

    def _empty(self) -> None:
        self.last_state: dict[str, int] = {}
        self.first = np.empty(0, np.int32)       # state -> its first transition
        self.upto = np.empty(0, np.float32)      # transition -> cumulated share, the last above 1
        self.piece = np.empty(0, np.int32)
        self.before = np.empty(0, np.int32)      # transition -> earlier state, -1 at the start

    def learn(self, segments: list[str]) -> None:
        """Forward passes over the segments' lattices, all at once.

        Characters of all segments lie in one array; the state after the
        character at ``p`` is ``p`` (plus the states held before).
        """
        texts = [s.removeprefix(SPLIT).replace(MARK, MASK) if s.startswith("\n") else MARK + s.replace(MARK, MASK)
                 for s in segments]
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        lens = np.array([len(t) for t in texts])
        ends = np.cumsum(lens)
        segment = np.repeat(np.arange(len(texts)), lens)
        start_of, end_of = (ends - lens)[segment], ends[segment]
        arcs = self._arcs(code, end_of)
        i, e, w, pid = arcs
        rel = e - start_of[e]
        order = np.lexsort((i, e, rel))
        i, e, w, pid, rel = i[order], e[order], w[order], pid[order], rel[order]
        inner = i > start_of[i]
        log_total = np.zeros(len(code))
        steps = np.searchsorted(rel, np.arange(int(rel[-1]) + 2)) if len(rel) else [0]
        for lo, hi in zip(steps[:-1], steps[1:]):           # one step per position within a segment
            came = w[lo:hi] + np.where(inner[lo:hi], log_total[i[lo:hi] - 1], 0.0)
            w[lo:hi] = came
            heads = np.flatnonzero(np.diff(e[lo:hi], prepend=-1))
            log_total[e[lo:hi][heads]] = np.logaddexp.reduceat(came, heads)
        order = np.lexsort((i, e))
        i, e, pid, share = i[order], e[order], pid[order], np.exp(w[order] - log_total[e[order]])
        heads = np.flatnonzero(np.diff(e, prepend=-1))
        run = np.cumsum(share)
        run -= np.repeat((run - share)[heads], np.diff(heads, append=len(e)))
        run[np.append(heads[1:], len(e)) - 1] = 2.0
        states, transitions = len(self.first), len(self.upto)
        before = np.where(i > start_of[i], states + i - 1, -1).astype(np.int32)
        first = (transitions + heads).astype(np.int32)
        extra = self._bytes(code, i, e, pid, before, states + len(code), transitions + len(e))
        self.first = np.concatenate([self.first, first, extra[0]])
        self.upto = np.concatenate([self.upto, run.astype(np.float32), np.full(len(extra[1]), 2.0, np.float32)])
        self.piece = np.concatenate([self.piece, pid.astype(np.int32), extra[1]])
        self.before = np.concatenate([self.before, before, extra[2]])
        self.last_state.update(zip(segments, (states + ends - 1).tolist()))

    def _arcs(self, code: np.ndarray, end_of: np.ndarray) -> tuple[np.ndarray, ...]:
        """First character, last character, log weight and id of every piece that fits; -1: bytes."""
        at, h = np.arange(len(code)), np.zeros(len(code), np.uint64)
        first, last, weight, pid = [], [], [], []
        for k in range(self.pieces.longest):
            live = at + k < end_of[at]
            at, h = at[live], h[live]
            h = extended(h, code[at + k])
            where = np.minimum(np.searchsorted(self.pieces.hashes, h), len(self.pieces.hashes) - 1)
            hit = self.pieces.hashes[where] == h
            if k == 0:
                none = np.ones(len(code), bool)
                none[at[hit & (self.pieces.id[where] >= 0)]] = False
                bare = np.flatnonzero(none)
                first, last = [bare], [bare]
                weight, pid = [np.zeros(len(bare))], [np.full(len(bare), -1, np.int32)]
            at, h, where = at[hit], h[hit], where[hit]
            own = self.pieces.id[where] >= 0
            first.append(at[own])
            last.append(at[own] + k)
            weight.append(self.pieces.log_weight[where[own]])
            pid.append(self.pieces.id[where[own]])
        return tuple(np.concatenate(x) for x in (first, last, weight, pid))

    def _bytes(self, code: np.ndarray, i: np.ndarray, e: np.ndarray, pid: np.ndarray, before: np.ndarray,
               states: int, transitions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte pieces for characters without one; a state more for every byte but the first."""
        first, piece, back = [], [], []
        bare = np.flatnonzero(pid < 0)
        ascii_ = code[e[bare]] < 128
        pid[bare[ascii_]] = self.pieces.byte_id[code[e[bare[ascii_]]]]
        for at in bare[~ascii_].tolist():
            c = chr(int(code[e[at]]))
            data = (MARK if c == MASK else c).encode("utf-8", "surrogatepass")
            pid[at] = self.pieces.byte_id[data[-1]]
            end, before[at] = before[at], states + len(first)
            for k in range(len(data) - 2, -1, -1):
                first.append(transitions + len(piece))
                piece.append(int(self.pieces.byte_id[data[k]]))
                back.append(states + len(first) if k else int(end))
        return tuple(np.array(x, np.int32) for x in (first, piece, back))

    def sample(self, texts: pa.Array, seeds: np.ndarray) -> pa.ListArray:
        """Sampled ids of every text (null and empty texts: an empty list)."""
        texts = pc.if_else(pc.equal(texts, ""), pa.scalar(None, texts.type), texts)
        texts = pc.replace_substring(texts, "\n", " \n")
        texts = pc.replace_substring_regex(texts, r"([A-Za-z])([.,])", rf"\1 {SPLIT}\2")
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        segments = coded.dictionary.to_pylist()
        if len(self.upto) > self.cache_arcs:
            self._empty()
        new = [s for s in segments if s not in self.last_state]
        if new:
            self.learn(new)
        last = np.array([self.last_state[s] for s in segments], np.int64)
        first, upto, piece, before = self.first, self.upto, self.piece, self.before
        n_segments = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
        of_doc = np.repeat(np.arange(len(n_segments)), n_segments)
        starts = np.concatenate([[0], np.cumsum(n_segments)])
        number = np.arange(len(of_doc)) - starts[of_doc]
        stream = seeds.view(np.uint64)[of_doc] + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        state = last[coded.indices.to_numpy()] if len(of_doc) else np.empty(0, np.int64)
        steps, taken, who = np.zeros(len(of_doc), np.int64), [], []
        active, turn = np.arange(len(of_doc)), 0
        while len(active):
            u = uniform(stream[active] + np.uint64(turn * 0xD1B54A32D192ED03 & (1 << 64) - 1))
            at = first[state].astype(np.int64)
            more = np.flatnonzero(upto[at] < u)
            while len(more):
                at[more] += 1
                more = more[upto[at[more]] < u[more]]
            taken.append(piece[at])
            who.append(active)
            steps[active] += 1
            state = before[at].astype(np.int64)
            live = state >= 0
            active, state, turn = active[live], state[live], turn + 1
        ends = np.cumsum(steps)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for turn, (p, w) in enumerate(zip(taken, who)):
            ids[ends[w] - 1 - turn] = p                   # walked from the end
        offsets = np.concatenate([[0], ends])[starts].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))


def uniform(x: np.ndarray) -> np.ndarray:
    """Mixes 64-bit numbers into floats in [0, 1)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)


def joined(pieces: Pieces, ids: pa.ListArray) -> pa.Array:
    """Texts (bytes) of id lists: pieces joined, the space mark in front of the text dropped."""
    flat = ids.flatten().to_numpy().astype(np.int32)
    offsets = ids.offsets.to_numpy() - ids.offsets[0].as_py()
    starts = offsets[:-1][np.diff(offsets) > 0]
    flat[starts] += pieces.size
    taken = pieces.raw.take(pa.array(flat))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), taken), pa.scalar(b"", pa.binary()))


def model_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path(MODEL))


def encode(docs: DataFrame, model: str | None = None, seed: str = SEED, theta: float = THETA,
           keep: Sequence[str] = (), repetitions: bool = False) -> DataFrame:
    """doc_id, ``keep`` columns, ids, lossless (whether decoding the ids gives the text back) of every row.

    With ``repetitions`` rows that repeat key and text are numbered, and each draws a segmentation of
    its own: the first that of the key alone, as without.  (This moves the texts once.)
    """
    model, kept = model or model_path(), ["doc_id", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model, theta)
        sampler = Sampler(pieces)
        for b in batches:
            if not b.num_rows:
                continue
            stream, texts = b.columns[-2:]
            ids = sampler.sample(texts, stream.to_numpy())
            same = pc.equal(joined(pieces, ids), texts.cast(pa.binary()))
            null = np.asarray(pc.is_null(texts))
            out = pa.ListArray.from_arrays(ids.offsets, ids.values, mask=pa.array(null)) if null.any() else ids
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], out, same], [*kept, "ids", "lossless"])

    key = key_text(F.col("doc_id"))
    stream = F.xxhash64(F.lit(seed), key)
    if repetitions:
        docs = docs.select(*kept, "text").withColumn("time_", F.row_number().over(
            Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))))
        stream = F.when(F.col("time_") == 1, stream).otherwise(F.xxhash64(F.lit(seed), key, F.col("time_")))
    src = docs.select(*kept, stream.alias("stream_"), "text")
    out = StructType([*src.schema.fields[:len(kept)], *StructType.fromDDL("ids array<int>, lossless boolean").fields])
    return src.mapInArrow(run, out)


def decode(tokens: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text of rows with doc_id and ids."""
    model = model or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for b in batches:
            ids = b.column(1)
            plain = pa.ListArray.from_arrays(*_compact(ids))
            texts = pc.if_else(pc.is_null(ids), pa.scalar(None, pa.binary()), joined(pieces, plain))
            yield pa.RecordBatch.from_arrays([b.column(0), texts.cast(pa.string())], ["doc_id", "text"])

    src = tokens.select("doc_id", "ids")
    return src.mapInArrow(run, StructType([src.schema["doc_id"], *StructType.fromDDL("text string").fields]))


def _compact(ids: pa.ListArray) -> tuple[pa.Array, pa.Array]:
    n = np.asarray(pc.fill_null(pc.list_value_length(ids), 0))
    return pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), ids.flatten()


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids, lossless: the sampled segmentation of every whole document."""
    return encode(table(prepare(spark), sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", "lossless")
