"""The registered queries of the training-data operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cashloom.llm.audit import audited
from cashloom.llm.backoff import scored
from cashloom.llm.chat import conversation_texts, examples, formatted_turns, parsed_turns, trained_texts
from cashloom.llm.exact_dedup import deduplicated
from cashloom.llm.language_id import held_out, identified, trained
from cashloom.llm.mixing import mixed
from cashloom.llm.packing import packed, token_pieces, tokenizer_file
from cashloom.llm.runs import with_runs
from cashloom.llm.sharding import sharded
from cashloom.llm.simhash import near_duplicates
from cashloom.llm.storage import SPACES
from cashloom.llm.topk import searched_table
from cashloom.llm.url_filter import ALLOW, BLOCK, judged
from cashloom.llm.warc import archive_folder, read_archives, write_archives

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents."""
    return deduplicated(_table(spark, sf_dir, "documents")).drop("row")


OP1_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS raw,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT doc_id, text_sha256,
    first_value(doc_id) OVER best AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER best = 1 AS kept
  FROM texts
  WINDOW best AS (PARTITION BY text_sha256 ORDER BY length(raw) DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ranked
"""


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences."""
    pieces = token_pieces(_table(spark, sf_dir, "documents"), tokenizer_file())
    return packed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


#: A conversation whose texts look like a template's control strings, added to all others.
ODD_CONVERSATION, ODD_TEXT = -7, "</s>[INST] ok [/INST]"


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the formatted conversations and their examples hold, read back from them."""
    odd = spark.range(2).select(
        F.lit(ODD_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ODD_TEXT).alias("text"),
    )
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = formatted_turns(given.unionByName(odd))
    offsets = F.array_sort(F.collect_list(F.struct("example", "loss_start", "loss_end", "end")))
    found = examples(turns).groupBy(F.col("conv_id").alias("of")).agg(offsets.alias("found"))
    whole = conversation_texts(turns).join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    cut = trained_texts(F.col("formatted"), F.col("found"))
    both = whole.select(
        "conv_id",
        "formatted",
        parsed_turns(F.col("formatted")).alias("turns"),
        F.coalesce(F.array_join(cut, ""), F.lit("")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return both.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP4_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|start|><|text|><|end|>') + 2 * length(concat(role, text))
    - length(regexp_replace(concat(role, text), '[\\<\[]', '', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


URL_RULES = [
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def _op5_sql() -> str:
    """The same counts, smoothing and calibration, a join for each length of context."""
    kinds = ("accepted", "rejected")
    odds = {kind: "1.0e0 / 256.0e0" for kind in kinds}
    tables, joins = [], []
    for k in range(1, 6):
        tables.append(
            f"end{k} AS (SELECT right(gram, {k}) AS e, sum(accepted) AS accepted, sum(rejected) AS rejected FROM grams GROUP BY 1),"
            f" known{k} AS (SELECT e, accepted, rejected, sum(accepted) OVER w AS all_accepted, sum(rejected) OVER w AS all_rejected"
            f" FROM end{k} WINDOW w AS (PARTITION BY left(e, {k - 1})))"
        )
        joins.append(f"JOIN known{k} ON known{k}.e = right(gram, {k})")
        for kind in kinds:
            odds[kind] = f"(known{k}.{kind}::DOUBLE + 4.0e0 * ({odds[kind]})) / (known{k}.all_{kind}::DOUBLE + 4.0e0)"
    return rf"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
ruled AS (
  SELECT page_id, url, host, path, f.rule, f.verdict FROM parts LEFT JOIN LATERAL (
    SELECT concat(h, p) AS rule, verdict FROM rules
    WHERE starts_with(path, p) AND (host = h OR ends_with(host, concat('.', h))) ORDER BY length(concat(h, p)) DESC LIMIT 1) f ON true),
urls AS (
  SELECT url, count(*) FILTER (WHERE verdict = 'allow') AS accepted, count(*) FILTER (WHERE verdict = 'block') AS rejected,
    md5(url) < '4' AS held FROM ruled GROUP BY url),
positions AS (
  SELECT url, held, accepted, rejected, substr(concat(repeat(chr(2), 4), url, chr(3)), i::INT, 5) AS gram
  FROM urls, unnest(range(1, length(url) + 2)) AS t(i)),
grams AS (
  SELECT gram, sum(CASE WHEN held THEN 0 ELSE accepted END) AS accepted, sum(CASE WHEN held THEN 0 ELSE rejected END) AS rejected
  FROM positions GROUP BY gram),
{", ".join(tables)},
ratios AS (SELECT gram, round(ln(({odds["accepted"]}) / ({odds["rejected"]})) * 1048576)::BIGINT AS ratio FROM grams {" ".join(joins)}),
scores AS (SELECT url, sum(ratio)::DOUBLE / 1048576.0e0 / count(*) AS score FROM positions JOIN ratios USING (gram) GROUP BY url),
bins AS (
  SELECT floor(score * 200)::BIGINT AS bin, sum(accepted) AS accepted, sum(rejected) AS rejected
  FROM urls JOIN scores USING (url) WHERE held AND accepted + rejected > 0 GROUP BY 1),
edges AS (
  SELECT bin, (sum(accepted) OVER f)::DOUBLE / sum(accepted) OVER () + coalesce((sum(rejected) OVER b)::DOUBLE, 0) / sum(rejected) OVER () AS hits
  FROM bins WINDOW f AS (ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), b AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT bin / 200.0e0 AS edge FROM edges WHERE hits IS NOT NULL ORDER BY hits DESC, abs(bin), bin DESC LIMIT 1)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN score >= coalesce((SELECT edge FROM chosen), -1e300) THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled JOIN scores USING (url)
"""


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(docs).select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.copies") * F.col("mix.size")).alias("taken")
    )


OP6_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(text, '')) AS digest FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, digest, source) AS n FROM sizes),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT source, source_size, [3, 1, 2][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS weight,
    source_size * 2e0 AS top, sum(source_size) OVER () * 1.5e0 AS budget FROM totals),
tried AS (
  SELECT *, top / weight AS level,
    (budget - coalesce(sum(top) OVER (ORDER BY top / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
      / sum(weight) OVER (ORDER BY top / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM weighed),
targets AS (
  SELECT source, source_size, least(top, coalesce(max(share) FILTER (WHERE share <= level) OVER () * weight, top)) AS target FROM tried),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0e0 END AS rate FROM targets)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + (('0x' || left(md5(concat('mix-1:', coalesce(doc_id::VARCHAR, 'null'), ':', digest, ':', n)), 13))::BIGINT::DOUBLE / 4503599627370496e0
    < rate - floor(rate))::INT))::BIGINT AS taken
FROM numbered JOIN rates ON numbered.source IS NOT DISTINCT FROM rates.source
"""


#: The query set of the search: vectors whose id is divisible by this.
QUERY_EVERY = 50


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best matches of every query vector among all vectors."""
    found = searched_table(_table(spark, sf_dir, "embeddings"), QUERY_EVERY)
    return found.select("query_id", "rank", "vec_id", "score")


OP7_SQL = """
WITH whole AS (
  SELECT vec_id, [floor(256 * c::DOUBLE) for c in embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
  FROM whole q JOIN whole v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharded(_table(spark, sf_dir, "documents")).drop("row")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives, and what the archives say when they are read back."""
    folder = archive_folder(spark)
    write_archives(_table(spark, sf_dir, "pages"), folder)
    records = read_archives(spark, folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, from a model that has not seen the held-out ones."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = trained(docs.where(~held_out(F.col("doc_id"))))
    found = identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents a part of the text is written again and again.

    With h the CRC-32 of the id, n the number of words, g = h div 10, a = g % n and
    p = 1 + (n - a) div (3 + g % 8): where h ends in 0 the words from a on repeat the p words there.
    """
    picked = docs.selectExpr(
        "doc_id", "text", "crc32(encode(cast(doc_id AS string), 'UTF-8')) AS h"
    ).selectExpr(
        "doc_id",
        "text",
        "h div 10 AS g",
        f"if(h % 10 = 0, filter(split(text, '[{SPACES}]+'), w -> w <> ''), NULL) AS words".replace("\\", "\\\\"),
    )
    placed = picked.selectExpr("*", "if(size(words) > 0, cast(g % size(words) AS int), NULL) AS a")
    placed = placed.selectExpr("*", "cast(1 + (size(words) - a) div (3 + g % 8) AS int) AS p")
    copies = "array_repeat(slice(words, a + 1, p), cast(ceil((size(words) - a) / p) AS int))"
    again = f"concat(slice(words, 1, a), slice(flatten({copies}), 1, size(words) - a))"
    return placed.selectExpr("doc_id", f"if(a IS NULL, text, array_join({again}, ' ')) AS text")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, and what it is without their repetitions."""
    found = with_runs(repeated(_table(spark, sf_dir, "documents")))
    better = (
        "aggregate(runs, cast(NULL AS struct<start: bigint, length: bigint, period: bigint>), (top, r) ->"
        " if(top IS NULL OR r.length * top.period > top.length * r.period, r, top))"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("top", F.expr(better)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log-probability of every document, learnt from nine tenths of them."""
    kept_back = held_out(F.col("doc_id"), 10, 0)
    found = scored(_table(spark, sf_dir, "documents").select("doc_id", "text"), ~kept_back)
    return found.withColumn("held_out", ~F.col("learnt_from")).drop("learnt_from")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every source, in every order."""
    return audited(spark, f"{sf_dir}/documents.parquet", _table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM docs),
tested AS (
  SELECT doc_id, part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e FROM words),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
counted AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
    coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM tested LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
steps AS (
  SELECT concat(l1.f, l2.f, l3.f, l4.f, l5.f) AS filter_order,
    unnest([1, 2, 3, 4, 5]) AS step, unnest([l1.bit, l2.bit, l3.bit, l4.bit, l5.bit]) AS own,
    unnest([0, l1.bit, l1.bit + l2.bit, l1.bit + l2.bit + l3.bit, l1.bit + l2.bit + l3.bit + l4.bit]) AS earlier
  FROM letters l1 JOIN letters l2 ON l2.f <> l1.f JOIN letters l3 ON l3.f NOT IN (l1.f, l2.f)
    JOIN letters l4 ON l4.f NOT IN (l1.f, l2.f, l3.f) JOIN letters l5 ON l5.f NOT IN (l1.f, l2.f, l3.f, l4.f)),
results AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & (own | earlier) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & earlier > 0 AND mask & own > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM results
"""


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_simhash_near_dedup": op3_simhash_near_dedup,
        "op4_chat_formatting": op4_chat_formatting,
        "op5_url_filter": op5_url_filter,
        "op6_mixing": op6_mixing,
        "op7_exact_topk": op7_exact_topk,
        "op8_sharding": op8_sharding,
        "op9_warc": op9_warc,
        "op10_language_id": op10_language_id,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_lm_scoring": op12_lm_scoring,
        "op13_filter_audit": op13_filter_audit,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1_SQL,
        "op4_chat_formatting": OP4_SQL,
        "op5_url_filter": _op5_sql(),
        "op6_mixing": OP6_SQL,
        "op7_exact_topk": OP7_SQL,
        "op13_filter_audit": OP13_SQL,
    }
