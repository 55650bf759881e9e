"""Scoring texts with a smoothed n-gram model, by an automaton with failure arcs.

The states of the automaton are the n-grams of fewer than ``order`` words that the training texts hold,
the empty one included. A state has an arc for every word that follows it there, with the smoothed
log-probability, to the longest state that ends like it; and a failure arc, with the log of the mass
left for other words, to the state without its first word. The empty state has an arc for every word,
known or not. A text is traversed once from left to right: the state is carried from word to word, and
where it has no arc for a word the failure arcs lead to one that has.

The probability of word w after the words h is (c(hw) + ``PRIOR`` * P(w | h')) / (c(h) + ``PRIOR``), with h'
being h without its first word, and (c(w) + ``ADDED``) / (N + ``ADDED`` * (V + 1)) at the end of the
chain: counts, tokens and different tokens of the training texts, an unknown word being one more. So
every state's probabilities add up to 1, and an n-gram that wasn't seen costs its failure arc.

All n-grams of the training texts count, and their tables grow with them; nobody holds them all. Texts
are cut into blocks of bounded size, stored with their words numbered. A block sends the hash and its
own count of each of its different n-grams to the range of hashes that it belongs to, gets back the
count in all blocks, and builds the part of the automaton that its texts can reach. An n-gram comes
once from a block however frequent it is, so a range's load depends on the blocks, not on hot words.
N-grams are known by 64-bit hashes: of a billion different ones, two share one with a chance of 3%.

Defined results: a null or empty text, or one without words, is its end token alone; repeated rows
count and score as rows of their own; a null id counts like the empty text when documents are held out;
where nothing is learnt from, every token has probability 1 at the end of the chain; texts of any
length are scored whole; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashloom.llm.storage import stored

#: Words of the longest n-grams. Longer ones take more shuffled bytes than there is text.
ORDER = 2
#: Weight of the shorter context in a probability, and what the count of every token is raised by.
PRIOR, ADDED = 2.0, 0.1
#: Tokens of a block, and n-grams of all blocks that one range of hashes is to hold.
BLOCK_TOKENS, RANGE_GRAMS = 400_000, 2_000_000
HASH_SEED = 42
MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, HASH_SEED)


# No word holds a blank.
START, END = word_hash(b" start"), word_hash(b" end")


def _planes(values: np.ndarray) -> bytes:
    """The values byte by byte, all first bytes first: high bytes are alike and compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _ascending(keys: np.ndarray) -> bytes:
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _from_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(data, np.uint64), dtype=np.uint64)


class Block:
    """Texts as one row of words, each with a start before it and an end token.

    ``vocabulary`` has the hashes of the different words, ``words`` their numbers, ``sizes`` the tokens
    of each text without the start.
    """

    def __init__(self, vocabulary: np.ndarray, words: np.ndarray, sizes: np.ndarray):
        self.vocabulary, self.words, self.sizes = vocabulary, words, sizes
        self.starts = np.cumsum(sizes + 1) - (sizes + 1)

    def grams(self, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For n of 1 to ``order``: hashes of the different n-grams, ascending; the number of the one that
        ends at each place, -1 where the text isn't so long yet; and a place where each ends."""
        place = np.arange(len(self.words)) - np.repeat(self.starts, self.sizes + 1)
        hashes = self.vocabulary[self.words]
        order_of_words = np.argsort(self.vocabulary)
        rank = np.empty_like(order_of_words)
        rank[order_of_words] = np.arange(len(rank))
        single = rank[self.words]
        first = np.empty_like(rank)
        first[single[::-1]] = np.arange(len(single))[::-1]
        out, now = [(self.vocabulary[order_of_words], single, first)], hashes
        for n in range(2, order + 1):
            there = np.flatnonzero(place >= n - 1)
            longer = np.zeros_like(now)
            longer[1:] = (now[:-1] * MIX + np.uint64(n)) ^ hashes[1:]
            longer ^= longer >> np.uint64(31)
            longer *= MIX
            now = longer ^ (longer >> np.uint64(29))
            keys, first, number = np.unique(now[there], return_index=True, return_inverse=True)
            ends = np.full(len(now), -1, np.int64)
            ends[there] = number
            out.append((keys, ends, there[first]))
        return out


class Automaton:
    """The part of the model's automaton that a block's texts can reach.

    States are numbered through all lengths, the empty one is 0; ``depth`` is a state's number of words. An
    arc has a weight and the state it goes to; ``arcs`` has, for each depth and each place of the texts,
    the arc for the word there that leaves the state of so many words before it, or -1 if that has none.
    ``fall`` is the weight of a state's failure arc to ``shorter``.
    """

    def __init__(self, block: Block, grams: list, counts: list[np.ndarray], tokens: int, kinds: int, prior: float, added: float):
        order = len(grams)
        state_at = [np.zeros(len(block.words), np.int64)]  # state of the last n words at each place
        fall, shorter, depth = [np.zeros(1)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        self.arcs, weights, targets = [], [], []
        states = 1
        lower = np.zeros(0)
        for n, (keys, ends, places) in enumerate(grams, start=1):
            seen = counts[n - 1]
            if n == 1:
                chance = (seen + added) / (tokens + added * (kinds + 1))
                leaves = np.ones(len(keys), bool)
            else:
                context, end = grams[n - 2][1][places - 1], grams[n - 2][1][places]
                chance = (seen + prior * lower[end]) / (counts[n - 2][context] + prior)
                leaves = seen > 0
            if n < order:
                known = seen > 0
                target = np.where(known, states + np.cumsum(known) - 1, state_at[n - 1][places])
                states += int(known.sum())
                fall.append(np.log10(prior / (seen[known] + prior)))
                shorter.append(state_at[n - 1][places][known])
                depth.append(np.full(int(known.sum()), n))
                there, longest = ends >= 0, state_at[n - 1].copy()
                longest[there] = target[ends[there]]
                state_at.append(longest)
            else:
                target = state_at[n - 1][places]
            number = np.where(leaves, sum(map(len, weights)) + np.cumsum(leaves) - 1, -1)
            # -1 in ends takes the last of number, which is -1
            self.arcs.append(np.append(number, -1)[ends])
            weights.append(np.log10(chance)[leaves])
            targets.append(target[leaves])
            lower = chance
        self.weights, self.targets = np.concatenate(weights).tolist(), np.concatenate(targets).tolist()
        self.fall, self.shorter, self.depth = (np.concatenate(x).tolist() for x in (fall, shorter, depth))
        self.opening = state_at[1][block.starts].tolist() if order > 1 else [0] * len(block.sizes)

    def log_probability(self, state: int, first: int, last: int) -> float:
        """Of the words from place ``first`` to before ``last``, read one after the other from ``state`` on."""
        weights, targets, fall, shorter, depth = self.weights, self.targets, self.fall, self.shorter, self.depth
        arcs = [a[first:last].tolist() for a in self.arcs]
        total = 0.0
        for place in range(last - first):
            arc = arcs[depth[state]][place]
            while arc < 0:
                total += fall[state]
                state = shorter[state]
                arc = arcs[depth[state]][place]
            total += weights[arc]
            state = targets[arc]
        return total


class _Words(dict):
    """Numbers of words, in the order in which they come up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _blocks(docs: DataFrame, learns: Column, doc_id: str, text: str, block_tokens: int) -> DataFrame:
    """Documents in blocks: block, ids, learns (by document), tokens, learnt, sizes, words, vocabulary.

    ``tokens`` are all of the block, ``learnt`` those to learn from.
    """
    source = docs.select(
        F.col(doc_id).alias("id"),
        F.coalesce(learns, F.lit(False)).alias("learns"),
        F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("text"),
    )
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"block long, ids array<{kind}>, learns array<boolean>, tokens long, learnt long, sizes binary, words binary, vocabulary binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        numbers, rows, held = _Words(), [], 0
        ids: list = []

        def made() -> pa.RecordBatch:
            vocabulary = np.array([START, END] + [word_hash(w) for w in list(numbers)[2:]], np.uint64)
            words = np.concatenate([w for w, _ in rows])
            sizes = np.array([len(w) - 1 for w, _ in rows], np.int64)
            id_list = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(id_list)], pa.int32()), id_list),
                    pa.array([[learnt for _, learnt in rows]], pa.list_(pa.bool_())),
                    pa.array([held], pa.int64()),
                    pa.array([sum(len(w) - 1 for w, learnt in rows if learnt)], pa.int64()),
                    pa.array([_planes(sizes)], pa.binary()),
                    pa.array([_planes(words)], pa.binary()),
                    pa.array([_planes(vocabulary)], pa.binary()),
                ],
                ["block", "ids", "learns", "tokens", "learnt", "sizes", "words", "vocabulary"],
            )

        def opened() -> None:
            numbers.clear()
            numbers[b" start"], numbers[b" end"] = 0, 1

        opened()
        for batch in batches:
            first = 0
            for row, (learnt, value) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2))):
                found = value.as_py().lower().split()  # of bytes: A-Z only, and blank and tab to carriage return only
                words = np.empty(len(found) + 2, np.int32)
                words[0], words[-1] = 0, 1
                words[1:-1] = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
                rows.append((words, learnt))
                held += len(found) + 1
                if held >= block_tokens:
                    ids.append(batch.column(0).slice(first, row + 1 - first))
                    yield made()
                    number, rows, held, ids, first = number + 1, [], 0, [], row + 1
                    opened()
            if first < batch.num_rows:
                ids.append(batch.column(0).slice(first))
        if rows:
            yield made()

    return source.mapInArrow(cut, schema)


def _read_block(words: bytes, vocabulary: bytes, sizes: bytes) -> Block:
    return Block(_from_planes(vocabulary, np.uint64), _from_planes(words, np.int32), _from_planes(sizes, np.int64))


def _totals(keys: pa.ChunkedArray, own: pa.ChunkedArray) -> tuple[list[int], np.ndarray, int]:
    """Where each block's n-grams begin, the count in all blocks of each, and how many that isn't 0 for but the start.

    A range is a worker's largest load, so arrays of its length are as few at a time as that takes.
    """
    cuts = [0, *np.cumsum([len(k.as_buffer()) // 8 for k in keys]).tolist()]
    grams, counts = np.empty(cuts[-1], np.uint64), np.empty(cuts[-1], np.uint32)
    for a, b, k, c in zip(cuts, cuts[1:], keys, own):
        grams[a:b], counts[a:b] = _from_ascending(k.as_buffer()), _from_planes(c.as_buffer(), np.uint32)
    order = np.argsort(grams)
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    different = grams[first]
    del grams
    sums = np.add.reduceat(counts, first, dtype=np.int64)
    kinds = int(((sums > 0) & (different != np.uint64(START))).sum())
    del different, counts
    totals = np.empty(len(order), np.int64)
    totals[order] = np.repeat(sums, np.diff(first, append=len(order)))
    return cuts, totals, kinds


def _counted(blocks: DataFrame, order: int, ranges: int) -> DataFrame:
    """block, range, n, counts: how often the training texts hold the block's n-grams of a range of hashes.

    Every range also has a row of block -1 for n = 1, with the number of its different tokens.
    """
    edges = [(1 << 64) * k // ranges for k in range(1, ranges)]

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pa.default_memory_pool().release_unused()
            for at in range(batch.num_rows):  # one by one: blocks are large
                row = batch.slice(at, 1).to_pylist()[0]
                block = _read_block(row["words"], row["vocabulary"], row["sizes"])
                learnt = np.repeat(np.array(row["learns"], bool), block.sizes + 1)
                for n, (keys, ends, _) in enumerate(block.grams(order), start=1):
                    own = np.bincount(ends[learnt & (ends >= 0)], minlength=len(keys)).astype(np.uint32)
                    cuts = np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]])
                    here = np.flatnonzero(np.diff(cuts))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(here), row["block"])),
                            pa.array(here.astype(np.int32)),
                            pa.array(np.full(len(here), n, np.int32)),
                            pa.array([_ascending(keys[cuts[r] : cuts[r + 1]]) for r in here], pa.binary()),
                            pa.array([_planes(own[cuts[r] : cuts[r + 1]]) for r in here], pa.binary()),
                        ],
                        ["block", "range", "n", "keys", "own"],
                    )

    requests = blocks.select("block", "learns", "sizes", "words", "vocabulary").mapInArrow(
        asked, "block long, range int, n int, keys binary, own binary"
    )

    def answered(group: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # or each worker keeps what its largest group took
        cuts, totals, kinds = _totals(group.column("keys"), group.column("own"))
        back = [_planes(totals[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        blocks = group.column("block").to_pylist()
        n, r = group.column("n")[0].as_py(), group.column("range")[0].as_py()
        return pa.table(
            {
                "block": pa.array([*blocks, -1], pa.int64()),
                "range": pa.array([r] * (len(blocks) + 1), pa.int32()),
                "n": pa.array([n] * (len(blocks) + 1), pa.int32()),
                "kinds": pa.array([0] * len(blocks) + [kinds if n == 1 else 0], pa.int64()),
                "counts": pa.array([*back, b""], pa.binary()),
            }
        )

    return requests.groupBy("range", "n").applyInArrow(answered, "block long, range int, n int, kinds long, counts binary")


def scored(
    docs: DataFrame,
    learns: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    prior: float = PRIOR,
    added: float = ADDED,
    block_tokens: int = BLOCK_TOKENS,
    range_grams: int = RANGE_GRAMS,
) -> DataFrame:
    """One row per document: its id, learnt_from, n_tokens, n_known, train_tokens, base_score and score.

    ``learns`` tells which documents the model learns from. ``base_score`` is the log10-probability by
    single tokens alone, ``score`` that of the model.
    """
    blocks = stored(_blocks(docs, learns, doc_id, text, block_tokens), "blocks")
    sizes = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"), F.coalesce(F.sum("learnt"), F.lit(0)).alias("learnt")).first()
    tokens, ranges = sizes["learnt"], max(1, -(-order * sizes["all"] // range_grams))
    counted = stored(_counted(blocks, order, ranges), "counts")
    kinds = counted.where("block < 0").agg(F.coalesce(F.sum("kinds"), F.lit(0)).alias("n")).first()["n"]
    kind = docs.schema[doc_id].dataType

    def traversed(texts: pa.Table, answers: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        block = _read_block(*(texts.column(c)[0].as_buffer() for c in ("words", "vocabulary", "sizes")))
        grams = block.grams(order)
        places = sorted(zip(answers.column("n").to_pylist(), answers.column("range").to_pylist(), range(len(answers))))
        none, found = np.zeros(0, np.int64), answers.column("counts")
        counts = [
            np.concatenate([none, *(_from_planes(found[at].as_buffer(), np.int64) for m, _, at in places if m == n)])
            for n in range(1, order + 1)
        ]
        automaton = Automaton(block, grams, counts, tokens, kinds, prior, added)
        of_token = counts[0][grams[0][1]]
        del grams, counts
        alone = np.log10((of_token + added) / (tokens + added * (kinds + 1)))
        alone[block.starts] = 0.0
        known = of_token > 0
        known[block.starts] = False
        scores = [
            automaton.log_probability(opening, start + 1, start + 1 + size)
            for opening, start, size in zip(automaton.opening, block.starts.tolist(), block.sizes.tolist())
        ]
        return pa.table(
            {
                "doc_id": texts.column("ids").combine_chunks().flatten(),
                "learnt_from": texts.column("learns").combine_chunks().flatten(),
                "n_tokens": pa.array(block.sizes),
                "n_known": pa.array(np.add.reduceat(known.astype(np.int64), block.starts)),
                "train_tokens": pa.array(np.full(len(scores), tokens, np.int64)),
                "base_score": pa.array(np.add.reduceat(alone, block.starts)),
                "score": pa.array(scores, pa.float64()),
            }
        )

    result = "learnt_from boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    asked = blocks.drop("tokens", "learnt").groupBy("block")
    found = counted.where("block >= 0").drop("kinds").groupBy("block")
    return asked.cogroup(found).applyInArrow(traversed, f"doc_id {kind.simpleString()}, {result}")
