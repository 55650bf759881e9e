"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained on the driver from a bounded sample of labelled documents (``SAMPLE_DOCS`` of
each language, ``SAMPLE_WINDOWS`` windows of each), and labels every byte of every text in the tasks;
a document's probabilities are the mean over all its bytes. Texts are read in windows of ``WINDOW``
bytes, each on its own, so that a text may be of any length.

Defined results: a text that is null or without a letter, or any text if there are no labels, is
``und`` with score zero; rows with equal texts get equal results; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashloom.llm.bigru import Network, fresh, probabilities, train
from cashloom.llm.storage import stored

UNKNOWN = "und"
HIDDEN, WINDOW = 8, 64
#: The sample: documents of each language, and windows of each document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 400, 4
#: Times as many documents of a language are looked at, by hashes of their ids and windows.
SPARE = 8
STEPS, BATCH, RATE, SEED = 240, 256, 0.03, 42
#: Windows read at once.
BATCH_WINDOWS = 2048
#: Decimals of a score; beyond them it may depend on how the rows were batched.
DECIMALS = 4


@dataclass
class LanguageModel:
    languages: list[str]
    network: Network | None


def held_out(doc_id: Column, parts: int = 4, remainder: int = 2) -> Column:
    """Whether a document is kept from training, by the hash of its id."""
    key = F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")
    return F.crc32(key) % parts == remainder


def sampled_windows(docs: DataFrame, text: str, lang: str, doc_id: str) -> DataFrame:
    """lang, part: windows at even distances from the documents of each language with the lowest hashes."""
    length = F.length(F.col(text))
    starts = [F.floor(length * k / SAMPLE_WINDOWS).cast("int") + 1 for k in range(SAMPLE_WINDOWS)]
    parts = F.array(*[F.substring(F.col(text), start, F.lit(WINDOW)) for start in starts])
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id", "parts"), "id", "parts")
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    rows = usable.select(F.col(lang).alias("lang"), F.col(doc_id).alias("id"), parts.alias("parts"))
    # a language's hashes are cut first at a height that leaves some times what is taken, so that a
    # language's task doesn't get rows of every other task; a language of fewer documents keeps all
    sizes = stored(usable.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("of_lang")), "languages")
    place = (F.shiftright(F.xxhash64("id", "parts"), 24) + F.lit(1 << 39)).cast("double") / F.lit(float(1 << 40))
    low = rows.join(sizes, "lang").where(place * F.col("of_lang") < SPARE * SAMPLE_DOCS)
    chosen = low.drop("of_lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_DOCS)
    return chosen.select("lang", "n", F.posexplode("parts").alias("k", "part"))


def as_windows(text: bytes, window: int) -> np.ndarray:
    """The bytes of a text as rows of ``window``, the last one filled up with zeros."""
    values = np.frombuffer(text, np.uint8)
    whole = len(values) // window * window
    rows = values[:whole].reshape(-1, window)
    if whole == len(values):
        return rows
    last = np.zeros((1, window), np.uint8)
    last[0, : len(values) - whole] = values[whole:]
    return np.concatenate([rows, last]) if whole else last


def trained(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> LanguageModel:
    """A model of the languages of ``docs``; its training data is bounded by the sample."""
    rows = [r for r in sampled_windows(docs, text, lang, doc_id).collect() if r["part"]]
    rows.sort(key=lambda r: (r["lang"], r["n"], r["k"]))
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return LanguageModel([], None)
    parts = [r["part"].encode()[:WINDOW] for r in rows]
    x = np.concatenate([as_windows(p, WINDOW) for p in parts]).T
    weight = (np.arange(WINDOW)[:, None] < np.array(list(map(len, parts)))).astype(np.float32)
    label = np.array([languages.index(r["lang"]) for r in rows])
    rng = np.random.default_rng(SEED)
    network = fresh(len(languages), HIDDEN, WINDOW, rng)
    return LanguageModel(languages, train(network, x, weight, label, STEPS, BATCH, RATE, rng))


def pooled(network: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities (texts, classes) over all bytes; texts must not be empty."""
    classes, window = len(network.bias), network.window
    sums, lengths = np.zeros((len(texts), classes)), np.array(list(map(len, texts)))
    held: list[tuple[int, np.ndarray, int]] = []
    count = 0

    def read() -> None:
        x = np.concatenate([rows for _, rows, _ in held])
        owner = np.concatenate([np.full(len(rows), i) for i, rows, _ in held])
        used = np.concatenate([np.minimum(window, left - window * np.arange(len(rows))) for _, rows, left in held])
        chance = probabilities(network, x.T)
        chance *= (np.arange(window)[:, None] < used)[:, None, :]
        of_window = chance.sum(axis=0)
        for c in range(classes):
            sums[:, c] += np.bincount(owner, of_window[c], len(texts))

    for i, text in enumerate(texts):
        rows, left = as_windows(text, window), len(text)
        while len(rows):
            taken = rows[: BATCH_WINDOWS - count]
            held.append((i, taken, left))
            rows, left, count = rows[len(taken) :], left - window * len(taken), count + len(taken)
            if count == BATCH_WINDOWS:
                read()
                held, count = [], 0
    if held:
        read()
    return sums / lengths[:, None]


def identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, the pooled probability of that language.

    Columns of these names, and one named language_text, are replaced.
    """
    docs = docs.drop("lang_pred", "score", "language_text")
    if model.network is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    readable = F.when(F.col(text).rlike(r"\p{L}"), F.encode(text, "UTF-8"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    network, names = model.network, [*model.languages, UNKNOWN]

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
            best, score = np.full(len(column), len(names) - 1), np.zeros(len(column))
            if len(there):
                chance = pooled(network, [column[int(i)].as_py() for i in there])
                best[there], score[there] = chance.argmax(axis=1), chance.max(axis=1)
            added = [pa.array([names[i] for i in best], pa.string()), pa.array(np.clip(score, 0, 1).round(DECIMALS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], [*batch.schema.names[:-1], "lang_pred", "score"])

    return docs.withColumn("language_text", readable).mapInArrow(labelled, ", ".join([*fields, "lang_pred string", "score double"]))
