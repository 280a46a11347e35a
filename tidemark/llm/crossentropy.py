"""LM scoring by cross-entropy difference of two matched bigram models.

A target and a background model share one vocabulary, the words of all
documents, and one smoothing. Their counts are taken from all documents: the
background from every one, the target from those marked as target. A document
is scored by the mean over its words of the target's loss less the background's;
the lower, the closer to the target.

Counts are those of the exact words and word pairs, known by 64-bit hashes, and
are never in one place. Documents are cut into blocks, which number their own
words. Each block asks once for each of its distinct words and pairs, with its
own counts; the requests are dealt by ranges of the hashes, each range adds
them up and answers every block with the sums. A frequent pair is thus one
request per block, however many documents have it. Only requests and answers
move: the blocks are written in buckets, and are asked and scored where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, stored, stored_by, strings

WORDS = 1 << 18  # vocabulary of a model that is given none
PAIRS = 1 << 20
BLOCK_BYTES = 8 << 20  # text of a block
RANGE_TOKENS = 1 << 21  # words of all documents per range of hashes, about
MIN_BITS = 6
PRIOR = 4.0  # words' weight of the unigram estimate in a pair's
HEAD = -1  # place of a block's word hashes among its documents
RESULT = "n_tokens bigint, target_loss double, background_loss double, score double"
REQUEST = "part bigint, block bigint, n_words bigint, hashes binary, counts binary"
ANSWER = "part bigint, block bigint, n_words bigint, counts binary, n_kinds bigint, n_background bigint, n_target bigint"


def numbered(text: str, known: dict[bytes, int]) -> np.ndarray:
    """The words of the lower-cased text as numbers; new words get the next ones in ``known``."""
    return np.array([known.setdefault(word, len(known)) for word in text.encode().lower().split()], np.int32)


def pair_numbers(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of neighbours (as two arrays of words), per word the number of its pair, and the word before it.

    The first word of a text has -1 before it, and its pair is the number after the last.
    """
    previous = np.concatenate([[-1], word[:-1]]).astype(np.int64)[:len(word)]
    previous[first] = -1
    inner = previous >= 0
    pairs, number = np.unique(previous[inner] << 32 | word[inner], return_inverse=True)
    pair = np.full(len(word), len(pairs), np.int64)
    pair[inner] = number
    return pairs >> 32, pairs & 0xFFFFFFFF, pair, previous


def slots(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Per word of one text its number and the number of its pair with the word before."""
    word = numbered(text, {})
    return word, pair_numbers(word, np.zeros(min(1, len(word)), np.int64))[2]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _packed(values: np.ndarray, kind: str = "<u8") -> bytes:
    """Numbers byte plane by byte plane, compressed; the planes of zeros take no room."""
    planes = values.astype(kind).view(np.uint8).reshape(len(values), -1).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(raw: bytes, kind: str = "<u8") -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.decompress(raw[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _encoder(block_bytes: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of a partition's documents: a row per document with its words' numbers, and one with the words' hashes."""
        names = ["block", "place", "doc_id", "n_tokens", "words"]
        task, made = TaskContext.get().partitionId(), 0
        known: dict[bytes, int] = {}
        place = size = 0
        for batch in batches:
            texts, at = strings(batch.column(1)), 0
            while at < len(texts):
                start, encoded = at, []
                while at < len(texts) and size < block_bytes:
                    encoded.append(numbered(texts[at], known))
                    size += len(texts[at]) + 1
                    at += 1
                n = len(encoded)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, task << 32 | made)), pa.array(np.arange(place, place + n, dtype=np.int32)),
                    batch.column(0).slice(start, n), pa.array([len(e) for e in encoded], pa.int64()),
                    pa.array([_packed(e, "<i4") if len(e) else b"" for e in encoded], pa.binary())], names=names)
                place += n
                if size >= block_bytes:
                    yield _head(task << 32 | made, known, batch.column(0).type, names)
                    known, place, size, made = {}, 0, 0, made + 1
        if place:
            yield _head(task << 32 | made, known, batch.column(0).type, names)

    return encoded


def _head(block: int, known: dict[bytes, int], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
    return pa.RecordBatch.from_arrays([
        pa.array([block], pa.int64()), pa.array([HEAD], pa.int32()), pa.nulls(1, kind), pa.array([0], pa.int64()),
        pa.array([hashes.tobytes()], pa.binary())], names=names)


class _Block:
    """The documents of a block in order, their words and pairs by number, and the hashes of both."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("place")
        words = rows.column("words").to_pylist()
        self.ids, self.places = rows.column("doc_id").slice(1), rows.column("place").to_numpy()[1:]
        self.sizes = rows.column("n_tokens").to_numpy()[1:]
        self.word = np.concatenate([np.zeros(0, np.int32), *[_unpacked(w, "<i4") for w in words[1:] if w]])
        first = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        left, right, self.pair, self.previous = pair_numbers(self.word, first)
        of_word = np.frombuffer(words[0], "<u8")
        of_pair = _mix(of_word[left] * np.uint64(0xC2B2AE3D27D4EB4F) + _mix(of_word[right]))
        self.hashes = (of_word, of_pair)


def _requests_of(bits: int):
    def requests(rows: pa.Table, marks: pa.Table) -> pa.Table:
        made: list[tuple] = []
        if rows.num_rows:
            block = _Block(rows)
            number = rows.column("block")[0].as_py()
            marked = np.repeat(np.isin(block.places, marks.column("at").to_numpy()), block.sizes)
            sides, parts = [], []
            for of, hashes in zip((block.word, block.pair), block.hashes):
                order = np.argsort(hashes)
                # pairs have one number more, that of first words
                both = [np.bincount(x, minlength=len(hashes) + 1)[:len(hashes)][order] for x in (of, of[marked])]
                sides.append((hashes[order], *both))
                parts.append((hashes[order] >> np.uint64(64 - bits)).astype(np.int64))
            asked = np.union1d(*parts)
            edges = [(np.searchsorted(p, asked), np.searchsorted(p, asked, "right")) for p in parts]
            for at, p in enumerate(asked.tolist()):
                # words, then pairs; the step from one to the other wraps around
                hashes, *both = (np.concatenate([x[a[at]:z[at]] for x, (a, z) in zip(side, edges)]) for side in zip(*sides))
                steps = np.diff(hashes, prepend=np.uint64(0))
                made.append((p, number, int(edges[0][1][at] - edges[0][0][at]), _packed(steps), _packed(np.concatenate(both))))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        columns = list(zip(*made)) or [()] * 5
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in REQUEST.split(", ")])

    return requests


def _answers(asked: pa.Table) -> pa.Table:
    """The sums of one range of hashes, for each block in the order it asked, and the number of distinct words and of all."""
    hashes = [np.cumsum(_unpacked(raw), dtype=np.uint64) for raw in asked.column("hashes").to_pylist()]
    counts = [_unpacked(raw).astype(np.int64).reshape(2, -1) for raw in asked.column("counts").to_pylist()]
    n_words = asked.column("n_words").to_pylist()
    sums = [np.empty_like(c) for c in counts]
    totals = []
    for mine in ([slice(0, n) for n in n_words], [slice(n, None) for n in n_words]):  # words, then pairs
        distinct, number = np.unique(np.concatenate([h[m] for h, m in zip(hashes, mine)]), return_inverse=True)
        edges = np.cumsum([len(h[m]) for h, m in zip(hashes, mine)])[:-1]
        total = np.zeros((2, len(distinct)), np.int64)
        for side in (0, 1):  # of all documents, of the target
            np.add.at(total[side], number, np.concatenate([c[side, m] for c, m in zip(counts, mine)]))
            for told, m, part in zip(sums, mine, np.split(number, edges)):
                told[side, m] = total[side, part]
        totals.append([total.shape[1], *total.sum(axis=1).tolist()])
    n, none = len(hashes), [None] * len(hashes)
    return pa.table({
        "part": pa.array([asked.column("part")[0].as_py()] * (n + 1), pa.int64()),
        "block": pa.array(asked.column("block").to_pylist() + [None], pa.int64()),
        "n_words": pa.array(n_words + [None], pa.int64()),
        "counts": pa.array([_packed(s.ravel()) for s in sums] + [None], pa.binary()),
        **{name: pa.array(none + [x], pa.int64()) for name, x in zip(("n_kinds", "n_background", "n_target"), totals[0])}})


@dataclass
class BigramModel:
    """Counts of numbered words and pairs, the sum of all words, and the size of the vocabulary."""

    words: np.ndarray
    pairs: np.ndarray
    total: float
    vocabulary: float = WORDS

    def losses(self, word: np.ndarray, pair: np.ndarray, previous: np.ndarray) -> np.ndarray:
        """Bits per word; a pair's estimate is drawn towards the word's own, smoothed over the vocabulary."""
        single = (self.words[word] + 1.0) / (self.total + self.vocabulary)
        seen = np.where(previous >= 0, self.words[previous], 0.0)
        # the first word of a text has no history but its place
        return np.where(previous >= 0, -np.log2((self.pairs[pair] + PRIOR * single) / (seen + PRIOR)), -np.log2(single))


def _scores_of(vocabulary: int, totals: dict[str, int]):
    def scores(rows: pa.Table, told: pa.Table) -> pa.Table:
        block = _Block(rows)
        told = told.sort_by("part")
        n_words = told.column("n_words").to_pylist()
        sums = [_unpacked(raw).reshape(2, -1) for raw in told.column("counts").to_pylist()]
        losses = {}
        for side, (name, total) in enumerate(totals.items()):
            counts = []
            for k, hashes in enumerate(block.hashes):
                own = [s[side, n:] if k else s[side, :n] for s, n in zip(sums, n_words)]
                mine = np.zeros(len(hashes) + 1)
                mine[np.argsort(hashes)] = np.concatenate(own) if own else 0
                counts.append(mine)
            model = BigramModel(counts[0], counts[1], float(total), float(vocabulary))
            losses[name] = model.losses(block.word, block.pair, block.previous)
        text = np.repeat(np.arange(len(block.sizes)), block.sizes)
        sizes = np.maximum(block.sizes, 1)
        means = [np.bincount(text, x, minlength=len(sizes)) / sizes
                 for x in (losses["target"], losses["background"], losses["target"] - losses["background"])]
        return pa.Table.from_arrays([block.ids, pa.array(block.sizes), *map(pa.array, means)],
                                    names=["doc_id", *[f.split()[0] for f in RESULT.split(", ")]])

    return scores


def score_documents(docs: DataFrame, target_ids: DataFrame, block_bytes: int = BLOCK_BYTES, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_tokens, target_loss, background_loss, score`` (means in bits per word).

    ``target_ids`` has the ``doc_id`` of target documents; repeated and null
    ones do not matter. Repeated rows are counted and scored each; further
    columns are ignored. A null text counts as empty; a text without words has
    0 in every field. Without target documents the target model is uniform;
    no rows give no rows.

    The words' numbers and the answers are written tables that grow with the
    input; the driver gets three sums.
    """
    bound_batches(docs.sparkSession)
    ident = docs.schema["doc_id"].dataType.simpleString()
    rows = stored_by(docs.select("doc_id", "text").mapInArrow(
        _encoder(block_bytes), f"block bigint, place int, doc_id {ident}, n_tokens bigint, words binary"), "blocks", "block")
    bits, n = MIN_BITS, rows.agg(F.sum("n_tokens")).first()[0] or 0
    while n >> bits > range_tokens:
        bits += 1
    wanted = target_ids.select(F.col("doc_id").alias("id")).where("id IS NOT NULL").distinct()
    # one plan at every size: the target ids grow with the input, so no size of theirs is worth a broadcast
    placed = rows.where(F.col("place") != HEAD).select(F.col("block").alias("of"), F.col("place").alias("at"), F.col("doc_id").alias("id"))
    marks = placed.join(wanted.hint("merge"), "id", "left_semi")
    asked = rows.groupBy("block").cogroup(marks.groupBy("of")).applyInArrow(_requests_of(bits), REQUEST)
    answers = stored(asked.groupBy("part").applyInArrow(_answers, ANSWER), "answers")
    sums = answers.where("block IS NULL").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_kinds", "n_background", "n_target")]).first()
    told = answers.where("block IS NOT NULL").select("block", "part", "n_words", "counts")
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _scores_of(sums[0], {"background": sums[1], "target": sums[2]}), f"doc_id {ident}, {RESULT}")
