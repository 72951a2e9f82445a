"""The queries of this subpackage, and the SQL that states their results where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tabloom.llm import alignment, binary_packing, bisectors, exact_dedup, fingerprint, html_text, licenses, line_dedup, mixing, packing, simhash, toxicity, urls
from tabloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, source: str, sql: str | None = None):
    """Register ``fn(df)`` over whole tables."""
    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(*[table(spark, folder, name) for name in source.split()])
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# The rules of the url query (verdict, host, start of the path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer: the one that the packing queries name, or another."""
    import public_tokenizers
    return public_tokenizers.path(name)


def clusters_sql(rounds: int = bisectors.ROUNDS, count: int = bisectors.CENTROIDS) -> str:
    """The rounds of the clustering one after another. Numbers are whole doubles below 2^53, so sums and products are exact."""
    score = "arg_min(c.c, (list_inner_product(c.x, c.x) - 2 * list_inner_product(v.x, c.x)) * 64 + c.c)"
    parts = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM kept QUALIFY row_number() OVER (ORDER BY h, x) <= {count})"""]
    for i in range(rounds):
        parts.append(f"""c{i + 1} AS MATERIALIZED (WITH near AS (SELECT v.rid, {score} AS c FROM kept v, c{i} c GROUP BY v.rid),
            parts AS (SELECT c, unnest(x)::BIGINT AS value, generate_subscripts(x, 1) AS i FROM near JOIN kept USING (rid)),
            means AS (SELECT c, list(mean ORDER BY i) AS x FROM (SELECT c, i, ((sum(value) - ((sum(value) % count(*)) + count(*)) % count(*)) // count(*))::DOUBLE AS mean FROM parts GROUP BY c, i) GROUP BY c)
            SELECT c, coalesce(m.x, o.x) AS x FROM c{i} o LEFT JOIN means m USING (c))""")
    return f"""WITH {", ".join(parts)},
        last AS (SELECT v.rid, {score} AS c FROM kept v, c{rounds} c GROUP BY v.rid),
        told AS (SELECT vec_id, c::INTEGER AS cluster, (list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, e.x) + list_inner_product(e.x, e.x))::BIGINT AS distance,
            sha256(array_to_string(list_transform(e.x, lambda y: y::BIGINT), ',')) AS centroid_sha256 FROM last JOIN kept v USING (rid) JOIN c{rounds} e USING (c))
        SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256 FROM told"""


@query("op1_line_dedup", "documents", r"""
    WITH split AS (SELECT coalesce(doc_id, 9223372036854775807) AS id, coalesce(text, '') AS text FROM documents),
    lines AS (SELECT id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM split),
    worded AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines),
    summed AS (SELECT *, sum(words) OVER (PARTITION BY id ORDER BY pos)::BIGINT AS upto, sum(words) OVER (PARTITION BY id ORDER BY pos)::BIGINT - words AS start
        FROM worded WHERE words > 0),
    runs AS (SELECT id, pos AS a, max(pos) OVER f AS b, string_agg(line, chr(10)) OVER f AS body, sum(words) OVER f AS words FROM summed
            WINDOW f AS (PARTITION BY id ORDER BY start RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
        UNION SELECT id, min(pos) OVER f, pos, string_agg(line, chr(10)) OVER f, sum(words) OVER f FROM summed
            WINDOW f AS (PARTITION BY id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
    copies AS (SELECT id, a, b, row_number() OVER (PARTITION BY body ORDER BY id, a) AS nth FROM runs WHERE words >= 50),
    hit AS (SELECT DISTINCT id, unnest(range(a, b + 1)) AS pos FROM copies WHERE nth > 1),
    seen AS (SELECT w.id, w.pos, w.line, CASE WHEN w.words > 0 THEN h.pos IS NOT NULL END AS hit FROM worded w LEFT JOIN hit h ON w.id = h.id AND w.pos = h.pos),
    marked AS (SELECT id, pos, line, coalesce(last_value(hit IGNORE NULLS) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false)
        AND coalesce(first_value(hit IGNORE NULLS) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), false) AS gone FROM seen)
    SELECT CASE WHEN id < 9223372036854775807 THEN id END AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM marked GROUP BY id""")
def op1(docs: DataFrame) -> DataFrame:
    """Every document without the later copies of long line runs."""
    return line_dedup.deduplicated(docs).drop("spans")


@query("op2_license_scan", "documents")
def op2(docs: DataFrame) -> DataFrame:
    """License labels of every document."""
    return licenses.summary(licenses.scan(docs))


@query("op3_html_extraction", "pages")
def op3(pages: DataFrame) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(pages)


@query("op4_url_filter", "pages")
def op4(pages: DataFrame) -> DataFrame:
    """Verdict on every page's url."""
    return urls.judge(pages, URL_RULES)


@query("op5_document_fingerprint", "documents")
def op5(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint.fingerprints_with_next(docs)


@query("op6_best_fit_packing", "documents")
def op6(docs: DataFrame) -> DataFrame:
    """Place of every token piece."""
    return packing.packed(docs, tokenizer_path())


@query("op7_source_mix", "documents", r"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
    totals AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place FROM d GROUP BY source),
    listed AS (SELECT *, [5, 2, 1][place + 1]::BIGINT AS weight, 2.0::DOUBLE * source_size / [5, 2, 1][place + 1] AS ratio FROM totals),
    ranked AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM totals)
            - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
            / (sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level FROM listed),
    goals AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * (SELECT arg_min(level, ratio) FROM ranked WHERE level <= ratio)) AS target FROM ranked),
    units AS (SELECT d.doc_id, d.source, d.size, g.source_size, g.target,
            CASE WHEN g.source_size > 0 THEN least(33554432, floor(g.target / g.source_size * 16777216 + 0.5)::BIGINT) ELSE 0 END AS units,
            ('0x' || substr(md5('20:' || coalesce(d.source, '')), 1, 6))::BIGINT AS start
        FROM d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
    sums AS (SELECT *, start + sum(units) OVER (PARTITION BY source ORDER BY size, doc_id NULLS LAST ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM units)
    SELECT doc_id, source, size, source_size, target, upto // 16777216 - (upto - units) // 16777216 AS copies,
        (upto // 16777216 - (upto - units) // 16777216) * size AS taken FROM sums""")
def op7(docs: DataFrame) -> DataFrame:
    """How often every document is taken."""
    return mixing.mixture(docs)


@query("op8_toxicity", "documents labels")
def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity score of every document."""
    scored = toxicity.scored(docs.select("doc_id", "text"), toxicity.train(docs, labels))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op9_simhash_near_dedup", "documents")
def op9(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(docs)


@query("op10_exact_dedup", "documents", r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY norm)""")
def op10(docs: DataFrame) -> DataFrame:
    """The row that stays for every document."""
    return exact_dedup.exact_groups(docs)


@query("op11_binary_packing", "documents")
def op11(docs: DataFrame) -> DataFrame:
    """Pieces of every document, each as long as a power of two."""
    return binary_packing.packed(docs, tokenizer_path(), ids=False)


@query("op12_centroid_clustering", "embeddings", clusters_sql())
def op12(vectors: DataFrame) -> DataFrame:
    """Cluster of every vector."""
    return bisectors.clusters(vectors)


@query("op13_tokenizer_alignment", "documents")
def op13(docs: DataFrame) -> DataFrame:
    """Alignment of two tokenizers over every document."""
    return alignment.alignments(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), digest=True).withColumnRenamed("groups", "groups_sha256")
