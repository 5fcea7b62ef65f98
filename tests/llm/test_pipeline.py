from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import sentencepiece
from llm_cases import awkward, near_groups, shingles

import corpus_pipeline
from pricecube.llm.line_dedup import MIN_PAGES, RATIO
from pricecube.llm.queries import QUERIES
from pricecube.llm.sentencepiece_bpe import default_model

SF = "/root/testdata/sf0.01"


def plain_lines(docs):
    pages, seen = Counter(s for _, _, s in docs), defaultdict(Counter)
    for _, t, s in docs:
        seen[s].update({x.strip(" ") for x in (t or "").split("\n")} - {""})
    gone = {s: {x for x, n in c.items() if n >= MIN_PAGES and n > RATIO * pages[s]} for s, c in seen.items()}
    return [(i, t if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in gone[s]), s) for i, t, s in docs]


def test_run_equals_a_plain_version(spark):
    """All but the classifier's verdicts is worked out again without Spark."""
    verdict = {r.doc_id: r.predicted for r in QUERIES["op7_quality"](spark, SF).collect()}
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if verdict[r.doc_id]]
    docs = plain_lines(docs)
    groups = near_groups([(i, t) for i, t, _ in docs])
    docs = [d for d in docs if groups[d[0], d[1]][2]]
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [d for d in docs if not any(4 * len(s & shingles(d[1])) >= 3 * len(s) for s in items)]
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    want = {}
    for i, t, _ in docs:
        ids = library.encode(t or "")
        want[i] = (len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))])
    got = {r[0]: tuple(r[1:]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 500 < len(got) < len(verdict)


def test_stages_on_awkward_rows(spark):
    """Columns of clashing names go through, and clean rows stay."""
    docs = awkward(spark, [(700 + i, f"a clean text number {i} of its own with several words", "en", "s") for i in range(20)])
    docs = docs.withColumnRenamed("key", "_key").withColumnRenamed("n", "n_lines")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.where("doc_id >= 700").count() == 20, name
        assert stage(spark, docs.limit(0), SF).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).collect() == []
