"""Registered queries over the dealt operators. Each reads whole tables and keeps no limit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op4_substring_dedup")
def op4(spark, sf):
    """Words covered by a repeated 20-word window, removed."""
    from tidemark.llm.substring import remove_repeats

    kept = remove_repeats(table(spark, sf, "documents"), 20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_bpe_round_trip")
def op1(spark, sf):
    """Ids of every text, and the text decoded from them, as digests."""
    from tidemark.llm.bpe import decode, encode

    path = vocabulary_path()
    return decode(encode(table(spark, sf, "documents"), path), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP10_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, payload_bytes, max(page_id) AS held FROM p WHERE payload_bytes >= 1000 GROUP BY ALL HAVING count(*) > 1)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN g.held IS NULL OR g.held = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.held <> p.page_id THEN g.held END AS refers_to
FROM p LEFT JOIN g USING (payload_digest, payload_bytes)
"""


@query("op10_warc_archives", OP10_SQL)
def op10(spark, sf):
    """Pages written to dictionary-compressed archives and read back."""
    from tidemark.llm.warc import round_trip

    return round_trip(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_near_dedup")
def op5(spark, sf):
    """Two-word shingles, similarity of 0.8: components, of which the smallest id stays."""
    from tidemark.llm.near import near_duplicates

    found = near_duplicates(table(spark, sf, "documents"), 2, 80)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


@query("op9_decontaminate")
def op9(spark, sf):
    """Test items of which half or more stands in a document, in whatever order."""
    from tidemark.llm.tiling import leaks

    return leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op8_language_id")
def op8(spark, sf):
    """Language of every text, learned from three of four folds."""
    from tidemark.llm.langid import fit, fold, predict

    docs = table(spark, sf, "documents")
    model = fit(docs.where(fold(docs, 4) != 2))
    held_out = F.coalesce(fold(docs, 4) == 2, F.lit(True))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op3_secret_scan")
def op3(spark, sf):
    """Base spans of every text, and those that inferred formats add."""
    from tidemark.llm.secrets import fit, scan

    docs = table(spark, sf, "documents")
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    spell = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))
    return scan(docs, fit(docs)).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(spell(F.filter("found", lambda x: x["base"])), 256).alias("base_sha256"),
        spell(F.col("found")).alias("spans"),
    )


@query("op6_quality_score")
def op6(spark, sf):
    """Quality of every text, learned from four of five folds."""
    from tidemark.llm.langid import fold
    from tidemark.llm.quality import fit, score

    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = fit(docs, labels.where(fold(labels, 5) != 0))
    scored = score(docs, model)
    held_out = F.coalesce(fold(scored, 5) == 0, F.lit(True))
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query("op7_nearest_vectors")
def op7(spark, sf):
    """Twenty nearest of every twentieth vector, by inner product."""
    from tidemark.llm.ann import nearest

    vectors = table(spark, sf, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


@query("op2_license_scan")
def op2(spark, sf):
    """License notices and texts of which a document holds four fifths or more in one place."""
    from tidemark.llm.licenses import scan

    return scan(table(spark, sf, "documents"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
      CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
k AS (SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query("op13_fill_in_middle", OP13_SQL)
def op13(spark, sf):
    """Texts rearranged for infilling, and rebuilt from that."""
    from tidemark.llm.fim import fill_in_middle, restore

    out = restore(fill_in_middle(table(spark, sf, "documents"), 1))
    digest = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digest)


def op12_sql(k: int = 16, rounds: int = 3) -> str:
    """The same rounds as plain joins: all vectors with all centroids, component by component."""
    steps = [
        "v AS (SELECT vec_id, row_number() OVER () AS rid, embedding FROM embeddings WHERE len(embedding) = 64 "
        "AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "x AS (SELECT vec_id, rid, unnest(range(64)) AS pos, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM v)",
        f"pick AS (SELECT rid, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), ''))) - 1 AS c FROM v QUALIFY c < {k})",
        "c0 AS (SELECT c, pos, x AS m FROM pick JOIN x USING (rid))",
    ]
    for r in range(rounds + 1):
        steps.append(f"d{r} AS (SELECT rid, vec_id, c, CAST(sum((x - m) * (x - m)) AS BIGINT) AS d FROM x JOIN c{r} USING (pos) GROUP BY ALL)")
        steps.append(f"a{r} AS (SELECT rid, vec_id, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)")
        if r < rounds:
            steps.append(f"s{r} AS (SELECT c, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{r} JOIN x USING (rid) GROUP BY ALL)")
            steps.append(f"c{r + 1} AS (SELECT o.c, o.pos, coalesce((s - ((s % n) + n) % n) // n, m) AS m FROM c{r} o LEFT JOIN s{r} t ON t.c = o.c AND t.pos = o.pos)")
    steps.append(f"h AS (SELECT c, sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY c)")
    return (
        f"WITH {', '.join(steps)} SELECT vec_id, CAST(c AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a{rounds} JOIN h USING (c)"
    )


@query("op12_centroid_clusters", op12_sql())
def op12(spark, sf):
    """Sixteen clusters after three rounds, by exact distances on integer vectors."""
    from tidemark.llm.pivots import cluster

    return cluster(table(spark, sf, "embeddings")).drop("n_measured")


@query("op11_token_files")
def op11(spark, sf):
    """Ids of all documents written to indexed files and read back."""
    from tidemark.llm.token_files import round_trip

    return round_trip(table(spark, sf, "documents"), vocabulary_path())
