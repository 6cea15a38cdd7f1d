"""Scores of texts under a smoothed n-gram model, walked as a weighted backoff automaton.

The model. Counts c(.) come from the training documents, each read as start, words, end. With
N tokens and V different ones, a token has P(w) = (c(w) + 1) / (N + V + 1); what was never seen
shares the remaining 1 / (N + V + 1). After a context h,

    P(w | h) = (1 - z) * c(hw) / c(h) + z * P(w | h')

where h' is h without its first word and z is how often contexts as frequent as h go on with something new:
the share of their tokens whose n-gram occurs once in all, by powers of two of c(h). That sums to
one over all words. Both the counts and the two dozen values z cover all training documents.

The automaton. A state is a context that was seen. An arc leads from h by w if hw was seen and
weighs log10 P(w | h); the failure arc of h leads to h' and weighs log10 z. One traversal from left
to right adds up the weights, so an unseen word costs one failure arc more.

At scale. Neither the model nor a text has to fit anywhere: documents are dealt into blocks of a
few MB, a block asks for the counts of just the n-grams that occur in it, and builds the part of
the automaton its texts can reach. Requests are 64-bit keys, dealt out by key, so that a frequent
n-gram is one key per block and no context gathers its successors. Answers come back in the order
of the request, without keys. Two different n-grams share a key with a chance of n * n / 2**65.

Null texts are empty, and an empty text is its end token. Without training documents every token
has probability one. Repeated rows are scored one by one; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from isobar.llm.common import GOLDEN, col, id_type, mixed, text_of, total_bytes
from isobar.session import shared_dir

# Keys of the two marks hold a space, which no word does.
START, END = b" start", b" end"
KEY_OF_START = np.uint64(xxhash.xxh64_intdigest(START))
BLOCK_BYTES = 4 << 20
#: Blocks for each bucket of answers; each pair of them is a row.
BLOCKS_PER_BUCKET = 4
LEAST_BLOCKS = 32

@dataclass
class Grams:
    """The different n-grams of one length in a block."""

    at: np.ndarray  # by position, the n-gram that ends there, or -1
    prefix: np.ndarray  # by n-gram, the one without its last word
    suffix: np.ndarray  # by n-gram, the one without its first word
    word: np.ndarray  # by n-gram, its last word
    key: np.ndarray
    count: np.ndarray  # in the block's training documents


@dataclass
class Block:
    first: np.ndarray  # by document, the position of its start mark; one more at the end
    token: np.ndarray  # by position
    grams: list[Grams]


def read_block(texts: pa.Array | pa.ChunkedArray, train: np.ndarray, order: int) -> Block:
    """Lower-case A-Z, cut at ASCII white space, number the words and the n-grams."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
    coded = split.flatten().dictionary_encode()
    different, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    of_text = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy())
    if "" in different:  # what white space at the ends leaves
        gap = different.index("")
        del different[gap]
        of_text, code = of_text[code != gap], code[code != gap]
        code = code - (code > gap)
    lengths = np.bincount(of_text, minlength=len(split)) + 2
    start = np.concatenate([[0], np.cumsum(lengths)])
    token = np.zeros(start[-1], dtype=np.int64)
    token[start[1:] - 1] = 1
    token[np.arange(len(code)) + 2 * of_text + 1] = code + 2
    learn = np.repeat(train, lengths)
    place = np.arange(len(token)) - np.repeat(start[:-1], lengths)
    keys = np.array([xxhash.xxh64_intdigest(w) for w in (START, END, *different)], dtype=np.uint64)
    n = len(keys)
    none = np.full(n, -1, dtype=np.int64)
    grams = [Grams(token, none, none, np.arange(n), keys, np.bincount(token[learn], minlength=n))]
    for k in range(2, order + 1):
        below = grams[-1]
        ends = np.flatnonzero(place >= k - 1)
        codes, inverse = np.unique(below.at[ends - 1] * n + token[ends], return_inverse=True)
        at = np.full(len(token), -1, dtype=np.int64)
        at[ends] = inverse
        prefix, word = codes // n, codes % n
        suffix = np.zeros(len(codes), dtype=np.int64)
        suffix[inverse] = below.at[ends]
        key = mixed(below.key[prefix] * GOLDEN + keys[word] + np.uint64(k))
        grams.append(Grams(at, prefix, suffix, word, key, np.bincount(inverse[learn[ends]], minlength=len(codes))))
    return Block(start, token, grams)


def request_order(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which keys are asked for, and the bucket of each in that order."""
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((key, bucket))
    return order, bucket[order]


def spaced(keys: np.ndarray, buckets: int) -> bytes:
    """Ascending keys of one bucket as the gaps between their quotients, byte by byte of all gaps: the high bytes are nearly
    all zero, so the shuffle's compression leaves some six bytes of a key."""
    return np.diff(keys // np.uint64(buckets), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unspaced(data: bytes, bucket: int, buckets: int) -> np.ndarray:
    gaps = np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()
    return np.cumsum(gaps, dtype=np.uint64) * np.uint64(buckets) + np.uint64(bucket)


def listed(values: np.ndarray, cuts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values))


def blocks_of(
    docs: DataFrame, train: Column, id_col: str, text_col: str, blocks: int
) -> DataFrame:
    return docs.select(
        F.pmod(F.xxhash64(col(id_col), text_of(text_col)), F.lit(blocks)).alias("block"),
        col(id_col).alias("id"),
        text_of(text_col).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )


def train_flags(rows: pa.Table) -> np.ndarray:
    return rows.column("train").to_numpy().astype(bool)


def count_answers(rows: DataFrame, order: int, buckets: int) -> DataFrame:
    """Per block, length and bucket the corpus counts of the block's n-grams, and for each bucket
    of single tokens a row of block -1: how many different ones were seen, and how often."""

    def ask(group: pa.Table) -> pa.Table:
        block = read_block(group.column("text"), train_flags(group), order)
        out = []
        for k, grams in enumerate(block.grams, 1):
            by, bucket = request_order(grams.key, buckets)
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(cuts, len(by))
            keys = grams.key[by]
            out.append(
                pa.table(
                    {
                        "block": pa.array(np.full(len(cuts), group.column("block")[0].as_py())),
                        "length": pa.array(np.full(len(cuts), k, dtype=np.int32)),
                        "bucket": pa.array(bucket[cuts]),
                        "keys": pa.array([spaced(keys[a:b], buckets) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                        "counts": listed(grams.count[by].astype(np.int32), ends),
                    }
                )
            )
        return pa.concat_tables(out)

    def answer(group: pa.Table) -> pa.Table:
        counts, of = group.column("counts").combine_chunks(), group.column("bucket")[0].as_py()
        keys = np.concatenate([unspaced(data, of, buckets) for data in group.column("keys").to_pylist()])
        different, where = np.unique(keys, return_inverse=True)
        totals = np.bincount(where, weights=counts.flatten().to_numpy(), minlength=len(different)).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(counts).to_numpy())])
        out = {
            "block": group.column("block").to_pylist(),
            "length": group.column("length").to_pylist(),
            "bucket": group.column("bucket").to_pylist(),
        }
        values = totals[where]
        if out["length"][0] == 1:
            counted = totals[different != KEY_OF_START]
            for c, v in (("block", -1), ("length", 1), ("bucket", out["bucket"][0])):
                out[c].append(v)
            values = np.concatenate([values, [np.count_nonzero(counted), counted.sum()]])
            ends = np.append(ends, len(values))
        return pa.table(
            {
                "block": pa.array(out["block"], pa.int64()),
                "length": pa.array(out["length"], pa.int32()),
                "bucket": pa.array(out["bucket"], pa.int64()),
                "totals": listed(values, ends),
            }
        )

    asked = rows.groupBy("block").applyInArrow(
        ask, "block long, length int, bucket long, keys binary, counts array<int>"
    )
    return asked.groupBy("length", "bucket").applyInArrow(
        answer, "block long, length int, bucket long, totals array<long>"
    )


def totals_of(block: Block, counts: pa.Table, buckets: int) -> list[np.ndarray]:
    """The answers to a block by n-gram, for each length."""
    counts, totals = counts.sort_by([("length", "ascending"), ("bucket", "ascending")]), []
    for k, grams in enumerate(block.grams, 1):
        own = counts.filter(pc.equal(counts.column("length"), k)).column("totals").combine_chunks()
        by, _ = request_order(grams.key, buckets)
        total = np.zeros(len(by), dtype=np.int64)
        total[by] = own.flatten().to_numpy()
        totals.append(total)
    return totals


def magnitude(count: np.ndarray) -> np.ndarray:
    """Power of two at or below a count."""
    return np.frexp(np.maximum(count, 1).astype(np.float64))[1] - 1


def novelty(rows: DataFrame, answers: DataFrame, order: int, buckets: int) -> list[np.ndarray]:
    """For each length of context, by magnitude of its count: how often something new follows."""

    def measure(group: pa.Table, counts: pa.Table) -> pa.Table:
        block = read_block(group.column("text"), train_flags(group), order)
        totals, out = totals_of(block, counts, buckets), []
        for k in range(1, order):
            grams = block.grams[k]
            size = magnitude(totals[k - 1][grams.prefix])
            all_of, new = (np.bincount(size, weights=w, minlength=64) for w in (grams.count, grams.count * (totals[k] == 1)))
            out += [(k, m, int(all_of[m]), int(new[m])) for m in range(64)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("length", "size", "n", "new"), columns, strict=True)})

    asked = answers.where("block >= 0")
    found = rows.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        measure, "length long, size long, n long, new long"
    ).groupBy("length", "size").agg(F.sum("n").alias("n"), F.sum("new").alias("new")).where("n > 0").collect()
    out = []
    for k in range(1, order):
        seen = sorted((r["size"], (r["new"] + 0.5) / (r["n"] + 1.0)) for r in found if r["length"] == k)
        sizes, shares = zip(*seen, strict=True) if seen else ((0,), (0.5,))
        out.append(np.interp(np.arange(64), sizes, shares))
    return out


class Automaton:
    """The states and arcs that the texts of one block can reach.

    A state is a seen n-gram that ends at the position before. The n-gram that is one word longer and ends at
    the next position, if it was seen, is the arc; positions know their n-grams, so no arc is looked up.
    """

    def __init__(
        self, block: Block, totals: list[np.ndarray], tokens: int, kinds: int, new_after: list[np.ndarray]
    ) -> None:
        self.block, self.known = block, totals[0] > 0
        probability = (totals[0] + 1.0) / (tokens + kinds + 1.0)
        self.root = np.log10(probability)
        #: By length: weights of the arcs by position, and what the failure arc of a state weighs and where it leads.
        self.arcs, self.falling, self.fail = [self.root[block.token]], [], []
        self.seen = [self.known[block.token]]
        for k in range(1, len(totals)):
            grams, context = block.grams[k], totals[k - 1]
            z = new_after[k - 1]
            self.falling.append(np.log10(z[magnitude(context)]).tolist())
            self.fail.append(block.grams[k - 1].suffix.tolist())
            of = context[grams.prefix]
            share = z[magnitude(of)]
            probability = (1 - share) * totals[k] / np.maximum(of, 1) + share * probability[grams.suffix]
            there = grams.at >= 0
            self.arcs.append(np.where(there, np.log10(probability)[grams.at], 0.0))
            self.seen.append(there & (totals[k] > 0)[grams.at])

    def walk(self, start: int, stop: int) -> float:
        """log10 of the probability of the tokens from ``start + 1`` on, after the mark at ``start``."""
        first, most = start + 1, len(self.arcs) - 1
        at = [g.at[start:stop].tolist() for g in self.block.grams[: max(most, 1)]]
        arcs, seen = ([x[start:stop].tolist() for x in xs] for xs in (self.arcs, self.seen))
        falling, fail, score = self.falling, self.fail, 0.0
        length = 1 if most and seen[0][0] else 0
        state = at[0][0]
        for i in range(1, stop - first + 1):
            while length and not seen[length][i]:
                score += falling[length - 1][state]
                state = fail[length - 1][state]
                length -= 1
            score += arcs[length][i]
            # The longest state that ends here: the arc's own n-gram, or one word less where that is as long as any.
            if length < most:
                length += seen[length][i]
            if length:
                state = at[length - 1][i]
        return score


def score(
    docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document (id, n_tokens, n_known, train_tokens, base_score, score): see the module.

    ``train`` says which documents the model learns from. ``base_score`` is the score by P(w) alone.
    """
    spark = docs.sparkSession
    size = total_bytes(docs, text_col)
    blocks = max(math.ceil(size / block_bytes), LEAST_BLOCKS)
    buckets = math.ceil(blocks / BLOCKS_PER_BUCKET)
    rows = blocks_of(docs, train, id_col, text_col, blocks)
    path = shared_dir(spark, "lm-counts")
    count_answers(rows, order, buckets).write.parquet(path)
    answers = spark.read.parquet(path)
    seen = answers.where("block = -1").select(F.sum(F.col("totals")[0]), F.sum(F.col("totals")[1])).first()
    kinds, tokens = (int(x or 0) for x in seen)
    new_after = novelty(rows, answers, order, buckets) if order > 1 else []
    kind = id_type(docs, id_col)
    schema = T.StructType(
        [T.StructField(id_col, kind), *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")),
         *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score"))]
    )

    def walk(group: pa.Table, counts: pa.Table) -> pa.Table:
        block = read_block(group.column("text"), train_flags(group), order)
        totals = totals_of(block, counts, buckets)
        automaton = Automaton(block, totals, tokens, kinds, new_after)
        root, known = automaton.root, automaton.known
        names: dict[str, list] = {n: [] for n in ("n_tokens", "n_known", "base_score", "score")}
        for a, b in zip(block.first[:-1].tolist(), block.first[1:].tolist(), strict=True):
            part = block.token[a + 1 : b]
            names["n_tokens"].append(b - a - 1)
            names["n_known"].append(int(known[part].sum()))
            names["base_score"].append(float(root[part].sum()))
            names["score"].append(automaton.walk(a, b))
        return pa.table(
            {
                id_col: group.column("id"),
                "n_tokens": names["n_tokens"],
                "n_known": names["n_known"],
                "train_tokens": pa.array([tokens] * len(group), pa.int64()),
                "base_score": names["base_score"],
                "score": names["score"],
            }
        )

    asked = answers.where("block >= 0")
    return rows.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(walk, schema)
