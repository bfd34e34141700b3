from collections import defaultdict

from tokenizers import Tokenizer

import corpus_pipeline
from lectern.llm.exact_dedup import normalise
from lectern.llm.secrets import masked
from lectern.llm.tokens import VOCABULARY
from test_packing import check_layout
from test_quality import brute_verdicts
from test_simhash import brute_components, slow_fingerprint


def survivors(documents):
    verdicts = brute_verdicts([(d.doc_id, d.lang, d.source, d.text) for d in documents])
    good = sorted((d for d in documents if verdicts[d.doc_id][1]), key=lambda d: d.doc_id)
    first = {}
    for d in good:
        first.setdefault(normalise((d.text or "").encode()), d)
    unique = list(first.values())
    prints = {d.doc_id: slow_fingerprint(d.text) for d in unique}
    roots = brute_components(set(prints.values()), 3)
    kept = {}
    for d in unique:
        kept.setdefault(roots[prints[d.doc_id]], d)
    return list(kept.values())


def test_stages_against_brute_force(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns, name
    got = {tuple(r) for r in docs.collect()}
    want = set()
    for d in survivors(documents):
        text = masked(d.text)
        want.add((d.doc_id, text, d.lang, d.source, d.n_chars if text == d.text else len(text)))
    assert got == want and 0 < len(got) < len(documents)


def test_run(spark, sf_dir, documents):
    library = Tokenizer.from_file(VOCABULARY)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    check_layout(rows, 1024)
    tokens = defaultdict(list)
    for row in sorted(rows, key=lambda row: row.piece):
        assert len(row.ids) == row.length
        tokens[row.doc_id] += row.ids
    assert tokens == {d.doc_id: [*library.encode(masked(d.text), add_special_tokens=False).ids, 2] for d in survivors(documents)}


def test_odd_rows(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string"
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, long, "en", "s", 1, "r"), (1, long, "en", "s", 1, "r"), (None, None, None, None, None, None), (2, "", "", "", 0, "")]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    assert [tuple(r) for r in docs.collect()] == [rows[0]]
    assert sum(r.length for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()) > 60_000


def test_empty(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
