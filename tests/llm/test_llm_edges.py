"""Empty tables, nulls in every column, repeated rows and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

from tabloom.llm import exact_dedup, fingerprint, html_text, licenses, line_dedup, mixing, packing, simhash, toxicity, urls
from tabloom.llm.queries import URL_RULES, tokenizer_path

LONG = "word " * 60
DOCS = [(1, "a b c d", "en", "s", 7), (1, "a b c d", "en", "s", 7), (2, None, None, None, None), (None, "a b c d", "en", None, 1), (None, None, None, None, None),
        (3, "", "en", "s", 0), (4, " \n\t ", "de", "t", 4), (5, LONG * 3000, "en", "t", 9), (6, LONG + "\n" + LONG, "en", "s", 3), (6, "other", "en", "s", 3), (0, "é é \U0001f600 x", "fr", "u", 2)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["id", "h", "fp", "part", "sums", "norm", "size", "y", "score", "label", "keep", "at", "level", "rank", "spans", "copies", "_copy", "units", "_score", "_place", "row", "c0", "c1", "fp_", "key", "n", "component"]

PER_DOCUMENT = {
    "line": line_dedup.deduplicated,
    "license": lambda d: licenses.summary(licenses.scan(d)),
    "fingerprint": fingerprint.fingerprints_with_next,
    "mixture": mixing.mixture,
    "simhash": simhash.near_duplicates,
    "groups": exact_dedup.exact_groups,
    "scored": lambda d: toxicity.scored(d, toxicity.Classifier(-1.0, {})),
}
OTHERS = {
    "rows": exact_dedup.deduplicated,
    "near": simhash.deduplicated,
    "mixed": mixing.mixed,
    "packed": lambda d: packing.packed(d, tokenizer_path()),
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)


@pytest.mark.parametrize("name", [*PER_DOCUMENT, *OTHERS])
def test_empty(spark, docs, name):
    out = (PER_DOCUMENT | OTHERS)[name](docs.limit(0))
    assert out.count() == 0 and "doc_id" in out.columns


@pytest.mark.parametrize("name", list(PER_DOCUMENT))
def test_row_per_document(docs, name):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in PER_DOCUMENT[name](docs).collect())
    assert got == sorted((r[0] is None, r[0] or 0) for r in DOCS)


@pytest.mark.parametrize("name", [*PER_DOCUMENT, *OTHERS])
def test_clashing_columns(docs, name):
    operator = (PER_DOCUMENT | OTHERS)[name]
    wide = docs.withColumns({c: F.lit("x") for c in CLASH})
    plain, more = operator(docs), operator(wide)
    keys = [c for c in plain.columns if c not in CLASH or name != "scored"]
    assert sorted(map(str, plain.select(*keys).collect())) == sorted(map(str, more.select(*keys).collect()))
    if name in ("rows", "near", "mixed"):
        assert more.columns == wide.columns and plain.columns == docs.columns


PAGES = [(1, "http://a.com/x", "<p>one <b>two</b></p>"), (1, "http://a.com/x", "<p>one <b>two</b></p>"), (None, None, None), (2, "nonsense", ""), (3, "://", "plain &amp; text"), (4, "http://A.B", "<" * 5000 + "<p>" * 3000 + "deep")]


@pytest.mark.parametrize("operator", [html_text.extract, lambda p: urls.judge(p, URL_RULES, labelled=[("spam.com", "/", 1), ("news.com", "/", 0)])])
def test_pages(spark, operator):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert operator(pages).count() == len(PAGES)
    assert operator(pages.limit(0)).count() == 0
    wide = pages.withColumns({c: F.lit("x") for c in ("id", "address", "text", "host", "path", "score", "rule", "source")})
    assert sorted(map(str, operator(wide).collect())) == sorted(map(str, operator(pages).collect()))


@pytest.mark.parametrize("columns", [[], CLASH])
def test_pipeline_stages(spark, tmp_path, docs, columns):
    """Every stage takes nulls, repeated rows, columns of its own names and an empty table."""
    import corpus_pipeline
    labels = spark.createDataFrame([(1, 0), (3, 1), (5, 0), (6, 0), (None, 1)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    wide = docs.withColumns({c: F.lit("x") for c in columns})
    for given in (wide, wide.limit(0)):
        now = given
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
            rows = now.collect()
            if name != "best_fit_packing":
                assert now.columns == given.columns and all(r[c] == "x" for r in rows for c in columns), name
                now = spark.createDataFrame(rows, given.schema)
        assert bool(rows) == (given is wide)


def test_unlike_documents_of_one_key_stay(spark):
    rows = [(1, "alpha beta gamma delta"), (1, "one two three four five"), (2, "six seven eight nine"), (None, "alpha beta gamma delta"), (2, "six seven eight nine"), (None, None)]
    got = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [rows[0], rows[1], rows[2], rows[5]]))
