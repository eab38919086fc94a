"""Scores of whole texts under a bigram language model held in Elias-Fano tries, one per shard of contexts.

The model is P(w | u) = (c(u w) + MU * P(w)) / (c(u) + MU) with P(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)); counts come from the
training texts. The tries store c(u w) / (c(u) + MU), quantised.

Tokens are hashed to 64 bits. A scan turns texts into chunks: token numbers, compressed, with the chunk's distinct tokens.
Each chunk then sends every shard its distinct bigrams, with their counts in training texts, once; the shard sums all chunks'
counts, builds its trie, and answers every chunk from it. Last, each chunk meets its answers and adds up its texts. What is
moved is distinct bigrams by chunk, combined before the shuffle, so a frequent word or pair is small; a context whose
successors are many is split over shards by successor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.batches import text_slices
from starloom.llm.trie import BigramTrie, restored
from starloom.operators.durable import durable

MU = 16.0
CHARS = 8_000_000  # of a chunk, about
SHARD_TOKENS = 500_000  # tokens per shard, about
LEAST_SHARDS, MOST_SHARDS = 32, 4096
#: Numbers that stand for the end of a text and for what precedes its first word.
END, BEGIN = 0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47


def _squeezed(x: np.ndarray) -> bytes:
    """Compressed bytes of small numbers, low and high halves apart."""
    halves = x.astype("<u4").view("<u2").reshape(-1, 2)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(halves.T).tobytes())


def _loosened(b: bytes) -> np.ndarray:
    halves = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), "<u2").reshape(2, -1)
    return np.ascontiguousarray(halves.T).view("<u4").ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _chunks(batches):
    """Chunks of (doc_id, text, trains) rows. Token number 0 is the end, number 1 what precedes a text."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for low, texts in text_slices(batch.column(1), CHARS, batch.num_rows):
            high = low + len(texts)
            hashes, ends = [], []
            for text in texts:
                words = text.encode("utf-8", "surrogatepass").lower().split()  # both only for ASCII
                hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
                hashes.append(np.array([END], np.uint64))
                ends.append(len(words) + 1)
            flat, ends = np.concatenate(hashes), np.cumsum(ends)
            found, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")
            order = order[found[order] != END]
            words = np.r_[np.array([END, BEGIN], np.uint64), found[order]]
            place = np.zeros(len(found), np.uint32)
            place[order] = np.arange(2, len(words), dtype=np.uint32)
            trains = batch.column(2).slice(low, high - low).to_numpy(zero_copy_only=False).astype(np.uint8)
            size = np.diff(ends, prepend=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, high - low], pa.int32()), batch.column(0).slice(low, high - low)),
                 *[pa.array([b], pa.binary()) for b in (trains.tobytes(), size.astype(np.int64).tobytes(), words.tobytes(), _squeezed(place[inverse]))],
                 pa.array([int(ends[-1])]), pa.array([int(size[trains == 1].sum())]), pa.array([int(trains.sum())])],
                names=["chunk", "doc_ids", "trains", "sizes", "words", "tokens", "n_tokens", "train_tokens", "train_docs"])
            number += 1


class Chunk:
    """A chunk's tokens, contexts, and distinct bigrams grouped by shard and context."""

    def __init__(self, trains: bytes, sizes: bytes, words: bytes, tokens: bytes):
        self.trains, self.sizes = np.frombuffer(trains, np.uint8).astype(bool), np.frombuffer(sizes, np.int64)
        self.words, self.tokens = np.frombuffer(words, np.uint64), _loosened(tokens).astype(np.int64)
        starts = np.cumsum(self.sizes) - self.sizes
        self.contexts = np.r_[np.int64(1), self.tokens[:-1]]
        self.contexts[starts] = 1
        self.in_training = np.repeat(self.trains, self.sizes)

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each token is a context, in all texts and in training texts."""
        return (np.bincount(self.contexts, minlength=len(self.words)), np.bincount(self.contexts[self.in_training], minlength=len(self.words)))

    def pairs(self, shards: int, split: dict[int, tuple[int, int]]) -> None:
        """Number the distinct bigrams in the order of (shard, context, successor)."""
        width = len(self.words)
        pair, self.which = np.unique(self.contexts * width + self.tokens, return_inverse=True)
        context, word = np.divmod(pair, width)
        successor = _mixed(self.words) >> np.uint64(64 - BigramTrie.SUCCESSOR_BITS)
        part = np.zeros(len(pair), np.uint64)
        if split:
            parts = np.array([split.get(w, (1, 0))[0] for w in self.words.tolist()], np.uint64)
            part = successor[word] % parts[context]
        shard = (_mixed(self.words[context] + part * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((successor[word], self.words[context], shard))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.which = rank[self.which]
        self.shard, self.context, self.word = shard[order], context[order], word[order]
        self.successor = successor[self.word]
        self.count = np.bincount(self.which[self.in_training], minlength=len(pair))

    def parcels(self):
        """(shard, contexts, fan, successors, counts) of each shard that the chunk has bigrams for."""
        cuts = np.flatnonzero(np.r_[True, self.shard[1:] != self.shard[:-1], True][:len(self.shard) + 1])
        for low, high in zip(cuts, np.r_[cuts[1:], len(self.shard)]):
            if low < high:
                context = self.context[low:high]
                firsts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
                yield int(self.shard[low]), low, high, self.words[context[firsts]], np.diff(np.r_[firsts, high - low]), self.successor[low:high], self.count[low:high]


PARTS = ("trains", "sizes", "words", "tokens")


def _split_contexts(chunks: DataFrame, tokens: int, shards: int) -> dict[int, tuple[int, int]]:
    """Contexts with a share of tokens above a quarter of a shard's: parts to split them into, and their training count.

    Candidates are those with half that share in some chunk, which any such context has. At most 4 * shards pass, so the list that is
    broadcast is bounded by MOST_SHARDS.
    """
    share = 0.25 / shards

    def candidates(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(*[row[p] for p in PARTS])
                often = chunk.totals()[0] >= share / 2 * len(chunk.tokens)
                yield pa.RecordBatch.from_arrays([pa.array(chunk.words[often].view(np.int64)), pa.array(chunk.totals()[0][often].astype(np.int64))], names=["word", "n"])

    kept = chunks.select(*PARTS).mapInArrow(candidates, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= share * tokens)
    listed = np.array([r["word"] for r in kept.collect()], np.int64).view(np.uint64)  # at most 4 * shards rows

    def counted(batches):
        total = np.zeros((len(listed), 2), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(*[row[p] for p in PARTS])
                every, training = chunk.totals()
                at = {w: i for i, w in enumerate(chunk.words.tolist())}
                for k, w in enumerate(listed.tolist()):
                    if w in at:
                        total[k] += every[at[w]], training[at[w]]
        yield pa.RecordBatch.from_arrays([pa.array(listed.view(np.int64)), pa.array(total[:, 0].copy()), pa.array(total[:, 1].copy())], names=["word", "n", "c"])

    if not len(listed):
        return {}
    sums = chunks.select(*PARTS).mapInArrow(counted, "word long, n long, c long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    return {r["word"] % (1 << 64): (max(1, int(np.ceil(r["n"] / (share * tokens)))), r["c"]) for r in sums.collect()}


def _answers(split: dict[int, tuple[int, int]]):
    """Build a shard's trie from all its parcels and answer each: training counts of its contexts, codes of its bigrams."""
    def run(table: pa.Table) -> pa.Table:
        parcels = []
        for row in table.to_pylist():
            fan = _loosened(row["fan"]).astype(np.int64)
            high = np.frombuffer(row["successors"], np.uint8, int(fan.sum()), int(fan.sum()) * 4).astype(np.uint64)
            low = np.frombuffer(row["successors"], "<u4", int(fan.sum())).astype(np.uint64)
            parcels.append((row["chunk"], np.frombuffer(row["contexts"], np.uint64), fan, high << np.uint64(32) | low, _loosened(row["counts"]).astype(np.int64)))
        context = np.concatenate([np.repeat(p[1], p[2])[p[4] > 0] for p in parcels])
        successor = np.concatenate([p[3][p[4] > 0] for p in parcels])
        count = np.concatenate([p[4][p[4] > 0] for p in parcels])
        order = np.lexsort((successor, context))
        context, successor, count = context[order], successor[order], count[order]
        first = np.r_[True, (context[1:] != context[:-1]) | (successor[1:] != successor[:-1])][:len(context)]
        begins = np.flatnonzero(first)
        count = np.add.reduceat(count, begins) if len(begins) else count
        context, successor = context[first], successor[first]
        starts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]][:len(context)])
        names = context[starts]
        sums = np.add.reduceat(count, starts) if len(starts) else np.zeros(0, np.int64)
        for i, w in enumerate(names.tolist()):
            if w in split:
                sums[i] = split[w][1]
        trie = BigramTrie.of(context, successor, count / (np.repeat(sums, np.diff(np.r_[starts, len(context)])) + MU))
        known = sum(1 for w in names.tolist() if w not in split and w != BEGIN)
        out = []
        for k, (chunk, contexts, fan, successors, _) in enumerate(parcels):
            at = np.minimum(np.searchsorted(names, contexts), max(len(names) - 1, 0))
            c = np.where(names[at] == contexts, sums[at], 0) if len(names) else np.zeros(len(contexts), np.int64)
            codes = trie.codes_of(contexts, fan, successors)
            out.append((chunk, table["shard"][0].as_py(), _squeezed(c & 0xFFFFFFFF), _squeezed(c >> 32), zstandard.ZstdCompressor(level=1).compress(codes.tobytes()), known if k == 0 else 0))
        return pa.Table.from_pydict(dict(zip(("chunk", "shard", "c_low", "c_high", "codes", "known"), map(list, zip(*out)))), schema=ANSWER)

    return run


ANSWER = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("c_low", pa.binary()), ("c_high", pa.binary()), ("codes", pa.binary()), ("known", pa.int64())])
SCORES = ["n_tokens", "n_known", "base_score", "score"]


def _summed(shards: int, split: dict[int, tuple[int, int]], tokens: int, distinct: int, train_docs: int, ids: pa.DataType):
    """Scores of a chunk's texts from its answers."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        answers = {r["shard"]: r for r in right.to_pylist()}
        for row in left.to_pylist():
            chunk = Chunk(*[row[p] for p in PARTS])
            chunk.pairs(shards, split)
            c, code = np.zeros(len(chunk.words), np.int64), np.zeros(len(chunk.shard), np.uint16)
            for shard, low, high, *_ in chunk.parcels():
                answer = answers[shard]
                context = chunk.context[low:high]
                firsts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
                c[context[firsts]] = _loosened(answer["c_low"]).astype(np.int64) | _loosened(answer["c_high"]).astype(np.int64) << 32
                code[low:high] = np.frombuffer(zstandard.ZstdDecompressor().decompress(answer["codes"]), np.uint16)
            if split:
                for i, w in enumerate(chunk.words.tolist()):
                    if w in split:
                        c[i] = split[w][1]
            own = c.copy()  # as tokens: the end is no context, and the beginning no token
            own[0], own[1] = train_docs, 0
            single = (own + 0.1) / (tokens + 0.1 * (distinct + 1))
            pair = restored(code) + MU / (c[chunk.context] + MU) * single[chunk.word]
            ends = np.cumsum(chunk.sizes)
            starts = ends - chunk.sizes
            values = (chunk.sizes, np.add.reduceat((own > 0)[chunk.tokens].astype(np.int64), starts), np.add.reduceat(np.log10(single)[chunk.tokens], starts),
                      np.add.reduceat(np.log10(pair)[chunk.which], starts))
            out.append(pa.table([pa.array(row["doc_ids"], ids), *[pa.array(v) for v in values]], names=["doc_id", *SCORES]))
        return pa.concat_tables(out) if out else pa.table([pa.array([], ids), *[pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]], names=["doc_id", *SCORES])

    return run


def score(docs: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_known, train_tokens, base_score, score. `trains` names the texts to learn from.

    A-Z are lower-cased; tokens are words between ASCII white space, then one end. A null text is empty and has the end alone.
    base_score is the sum of log10 P(w) over the tokens, score that of log10 P(w | u), u the token before or the beginning. n_known counts
    tokens that occur in training texts. Rows that repeat are texts of their own. Without a training text all scores are 0. An
    empty table gives no rows.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"))
    kind = slim.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("doc_ids", T.ArrayType(kind)),
                           *[T.StructField(p, T.BinaryType()) for p in PARTS],
                           *[T.StructField(n, T.LongType()) for n in ("n_tokens", "train_tokens", "train_docs")]])
    chunks = durable(slim.mapInArrow(_chunks, schema), "lm-chunks")
    whole = chunks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_tokens", "train_tokens", "train_docs")]).first()
    all_tokens, tokens, train_docs = whole
    shards = min(max(-(-all_tokens // SHARD_TOKENS), LEAST_SHARDS), MOST_SHARDS)
    split = _split_contexts(chunks, all_tokens, shards)
    sent = docs.sparkSession.sparkContext.broadcast(split)

    def parcels(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(*[row[p] for p in PARTS])
                chunk.pairs(shards, sent.value)
                for shard, _, _, contexts, fan, successors, counts in chunk.parcels():
                    packed = (successors & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (successors >> np.uint64(32)).astype(np.uint8).tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["chunk"]]), pa.array([shard], pa.int32()), *[pa.array([b], pa.binary()) for b in (contexts.tobytes(), _squeezed(fan), packed, _squeezed(counts))]],
                        names=["chunk", "shard", "contexts", "fan", "successors", "counts"])

    asked = chunks.select("chunk", *PARTS).mapInArrow(parcels, "chunk long, shard int, contexts binary, fan binary, successors binary, counts binary")
    answers = durable(asked.groupBy("shard").applyInArrow(lambda t: _answers(sent.value)(t), "chunk long, shard int, c_low binary, c_high binary, codes binary, known long"), "lm-answers")
    known = answers.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    distinct = known + sum(1 for w, (_, c) in split.items() if c and w != BEGIN) + (train_docs > 0)
    out = T.StructType([T.StructField("doc_id", kind), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    ids = pa.string() if kind == T.StringType() else pa.int32() if kind == T.IntegerType() else pa.int64()
    summed = chunks.select("chunk", "doc_ids", *PARTS).groupBy("chunk").cogroup(answers.drop("known").groupBy("chunk")).applyInArrow(
        lambda left, right: _summed(shards, sent.value, tokens, distinct, train_docs, ids)(left, right), out)
    return summed.select("doc_id", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
