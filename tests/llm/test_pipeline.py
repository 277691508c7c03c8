"""The pipeline against a brute-force version of its stages."""

import duckdb
import public_tokenizers

import corpus_pipeline
from ledgerlens.llm import decontaminate, mixing, token_counts, toxicity
from ledgerlens.llm.common import table
from test_operators import plain_components, plain_digest, plain_fingerprint, rows_of

SMALL = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    documents, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    docs = [tuple(r) for r in documents.collect()]
    model = toxicity.fit(documents, labels)
    docs = [d for d in docs if model.chances(d[1])[0] < 0.5]
    groups = plain_components([plain_fingerprint(d[1]) for d in docs], [d[0] for d in docs])
    docs = [d for d, g in zip(docs, groups) if d[0] == g]
    items = decontaminate.Items([tuple(r) for r in table(spark, SMALL, "benchmark").select("item_id", "text").collect()])
    items.choose_seeds({})
    docs = [d for d in docs if not items.matches(d[1])]
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(docs, documents.schema).toArrow())
    taken = {r[0]: r[4] // r[1] for r in con.sql(mixing.sql()).project("doc_id, size, source_size, target, taken").fetchall() if r[1]}
    rows = [d for d in docs for _ in range(taken.get(d[0], 0))]
    library = token_counts.library(public_tokenizers.path("word_bpe_49k.json"))
    got = rows_of(corpus_pipeline.run(spark, SMALL), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == sorted(plain_digest(rows, library), key=repr)


def test_stages_keep_the_columns(spark):
    documents = table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, documents, SMALL)
        assert out.columns == documents.columns and 0 < out.count() <= 3 * documents.count()


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "alpha beta gamma delta epsilon"), (2, "alpha beta gamma delta epsilon"), (2, "another clean text of id two"), (3, "a third one, quite its own"),
    (3, "a third one, quite its own"), (None, "nobody's text stands here once"), (None, "nobody's text stands here once"), (None, "Alpha beta gamma delta epsilon"),
    (4, None), (None, ""), (5, ""),
]


def small(spark, rows):
    return spark.createDataFrame([(k, t, "en", "web", 1) for k, t in rows], DOCS)


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_near_copies_go_by_row_and_not_by_id(spark):
    """Repeated and null ids: a clean text stays whatever else its id stands on; each group keeps one row, empty texts being one group."""
    got = kept(corpus_pipeline.drop_near_copies(spark, small(spark, ROWS), SMALL))
    assert got == sorted([ROWS[0], ROWS[2], ROWS[3], ROWS[5], (4, None)], key=repr)
    # The rule does not change with repeats elsewhere in the table.
    assert kept(corpus_pipeline.drop_near_copies(spark, small(spark, ROWS[5:7]), SMALL)) == [ROWS[5]]
    assert kept(corpus_pipeline.drop_near_copies(spark, small(spark, ROWS[:3]), SMALL)) == sorted([ROWS[0], ROWS[2]], key=repr)


def test_contamination_goes_by_text(spark):
    item = table(spark, SMALL, "benchmark").where("length(text) > 80").first()["text"]
    rows = [(1, item), (1, "a clean text under the same id"), (None, f"before {item} after"), (None, "clean and nameless"), (2, None), (2, item), (3, "")]
    got = kept(corpus_pipeline.drop_contaminated(spark, small(spark, rows), SMALL))
    assert got == sorted([rows[1], rows[3], rows[4], rows[6]], key=repr)


def test_stages_take_empty_tables(spark):
    empty = small(spark, []).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SMALL)
        assert out.count() == 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == empty.columns
