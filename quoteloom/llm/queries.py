"""The registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.llm import (
    bpe,
    decontaminate,
    dialogue,
    extract,
    merkle,
    neighbours,
    passages,
    pii,
    repeats,
    simhash,
    toxicity,
    urls,
    voting,
)
from quoteloom.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.summary(table(spark, sf_dir, "documents"), 200)
    return found.withColumnRenamed("kept", "kept_sha256")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), window=10)
    hits = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    items = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


OP4_SQL = r"""
WITH items AS (
  SELECT item_id, w, least(len(w), 10) AS l
  FROM (
    SELECT item_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
  ) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, l, array_to_string(w[p : p + l - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS p FROM items)
), docs AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), grams AS (
  SELECT r, l, p, array_to_string(w[p : p + l - 1], ' ') AS g
  FROM (
    SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS p
    FROM docs, (SELECT DISTINCT l FROM items)
  )
), found AS (
  SELECT r, p, grams.l, item_id FROM grams JOIN windows ON grams.l = windows.l AND grams.g = windows.g
), hits AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + l)) AS q FROM found) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits ON docs.r = hits.r LEFT JOIN hit_items ON docs.r = hit_items.r
"""


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    order = F.create_map(*[F.lit(x) for i, k in enumerate(pii.KINDS) for x in (k, i)])

    def of(kind):
        return F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))

    def joined(spans):
        keyed = F.transform(spans, lambda s: F.struct(order[s["kind"]], s["start"], s["end"], s["kind"]))
        texts = F.transform(
            F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        )
        return F.concat_ws(",", texts)

    base = F.filter("pii", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"), [*urls.HOST_RULES, *urls.PATTERN_RULES])
    listed = [r.name for r in urls.HOST_RULES]
    rule = F.when(F.col("rule").isin(listed), F.col("rule"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), "verdict")


OP6_SQL = """
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
      THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), q AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(rest, '^[^/?#]*([^?#]*)(.*)$', 2) AS tail
  FROM p
), r AS (
  SELECT page_id, host, path, tail, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM q
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(tail, '[?&](?i:phpsessid)=')
      OR regexp_matches(path, '/(?i:login|signup)([/.]|$)')
      OR regexp_matches(path, '/(?i:cart)(/|$)')
      OR regexp_matches(host, '(^|[.])adserver[.]')
      OR (tail = '' AND regexp_matches(path, '[.](?i:exe)$')) THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.near_passages(table(spark, sf_dir, "documents"), words=50, similarity=0.8)
    words = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    return found.select("doc_id", "class_id", "links", words.alias("n_words_in_spans"), "spans")


def op8_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = str(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = bpe.encode(docs, vocabulary).select("doc_id", "ids")
    decoded = bpe.decode(tokens, vocabulary)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = voting.fit(docs, table(spark, sf_dir, "labels"))
    return voting.score(docs, model).select(
        "doc_id",
        voting.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


RECORD = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    longer = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    changed = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0,
        merkle.record_digest([longer.get(c, F.col(c)) for c in RECORD]),
    )
    found = merkle.manifest(docs, RECORD, id="doc_id", group="lang", fanout=2, extra={"tampered": changed})
    folded = found.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.siblings_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


OP12_SQL = """
WITH RECURSIVE parts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    CASE WHEN n_chars IS NOT NULL AND xor(
      list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
          lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
      4294967295) % 7 = 0 THEN CAST(n_chars AS HUGEINT) + 1 ELSE n_chars END AS changed
  FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM (
    SELECT r, doc_id, lang,
      sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
      sha256(head || coalesce(strlen(CAST(changed AS VARCHAR)) || ':' || changed, '-') || tail) AS changed
    FROM parts
  )
), up AS (
  SELECT 0 AS level, lang, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, lang, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM up WHERE n > 1 GROUP BY level, lang, n, pos // 2
), nodes AS MATERIALIZED (SELECT * FROM up), tops AS MATERIALIZED (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), root_up AS (
  SELECT 0 AS level, pos, n, h FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM root_up WHERE n > 1 GROUP BY level, n, pos // 2
), root_nodes AS MATERIALIZED (SELECT * FROM root_up), walk AS (
  SELECT r, 0 AS level, lang, pos, n, '' AS proof, changed AS folded FROM leaves
  UNION ALL
  SELECT r, walk.level + 1, walk.lang, walk.pos // 2, (walk.n + 1) // 2, proof || coalesce(s.h, ''),
    sha256(CASE WHEN walk.pos % 2 = 1 THEN s.h || folded ELSE folded || coalesce(s.h, '') END)
  FROM walk LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM walk.lang AND s.level = walk.level
    AND s.pos = xor(walk.pos, 1)
  WHERE walk.n > 1
), root_walk AS (
  SELECT r, 0 AS level, tops.pos, tops.n, proof, folded, tops.h AS subroot
  FROM walk JOIN tops ON tops.lang IS NOT DISTINCT FROM walk.lang WHERE walk.n = 1
  UNION ALL
  SELECT r, w.level + 1, w.pos // 2, (w.n + 1) // 2, proof || coalesce(s.h, ''),
    sha256(CASE WHEN w.pos % 2 = 1 THEN s.h || folded ELSE folded || coalesce(s.h, '') END), subroot
  FROM root_walk w LEFT JOIN root_nodes s ON s.level = w.level AND s.pos = xor(w.pos, 1) WHERE w.n > 1
)
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM root_walk w JOIN leaves ON leaves.r = w.r CROSS JOIN (SELECT h FROM root_nodes WHERE n = 1)
WHERE w.n = 1
"""


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with some turns lost, emptied, without their marks, repeated or of a wrong role."""
    space = F.lit(" ")
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(named.cast("binary")) % 20
    text = F.coalesce("text", space)
    changed = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce("role", space))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return turns.select(
        "conv_id", "turn", role.alias("role"), changed.alias("text"), F.explode(F.array_repeat(F.lit(0), copies))
    ).drop("col")


def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return dialogue.report(dialogue.repair(damaged(turns)), turns.select("conv_id"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_repeats": op2_repeats,
    "op3_neighbours": op3_neighbours,
    "op4_decontaminate": op4_decontaminate,
    "op5_pii": op5_pii,
    "op6_url_filters": op6_url_filters,
    "op7_passages": op7_passages,
    "op8_extract": op8_extract,
    "op9_simhash": op9_simhash,
    "op10_bpe": op10_bpe,
    "op11_quality": op11_quality,
    "op12_merkle": op12_merkle,
    "op13_dialogue": op13_dialogue,
}

ORACLES = {
    "op4_decontaminate": OP4_SQL,
    "op6_url_filters": OP6_SQL,
    "op12_merkle": OP12_SQL,
}
