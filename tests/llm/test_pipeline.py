"""The pipeline's stages against brute-force versions, and the queries' registration."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from llm.conftest import SMOKE, collected
from llm.test_minhash import brute as near_groups
from llm.test_packing import check_sequences, expected_pieces
from marquee.llm.quality import quality
from marquee.llm.queries import QUERIES
from marquee.llm.secret_scan import redacted
from marquee.plans.materialize import materialize

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage."""
    docs = [spark.read.parquet(f"{SMOKE}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(materialize(stage(spark, docs[-1], SMOKE), name))
    return docs


def rows_of(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "minhash_near_dedup", "secret_scans", "best_fit_packing"]


def test_stages_return_documents(stages):
    for frame in stages[1:5]:
        assert frame.dtypes == stages[0].dtypes


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    kept = {r.doc_id for r in quality(stages[0], labels).filter("kept").collect()}
    assert rows_of(stages[1]).keys() == kept and 0 < len(kept) < stages[0].count()


def test_exact_stage(stages):
    least = {}
    for i, r in sorted(rows_of(stages[1]).items()):
        least.setdefault(re.sub(r"[ \t-\r]+", " ", r.text), i)
    assert rows_of(stages[2]).keys() == set(least.values())


def test_near_stage(stages):
    before = rows_of(stages[2])
    groups = near_groups([(i, r.text) for i, r in before.items()], 5)
    assert rows_of(stages[3]).keys() == {doc for doc, _, _, kept in groups if kept}


def test_secret_stage(stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    assert before.keys() == after.keys()
    for i, r in before.items():
        text = redacted(r.text)
        assert after[i].text == text and after[i].n_chars == (r.n_chars if text == r.text else len(text))
        assert (after[i].source, after[i].lang) == (r.source, r.lang)


def test_packing_stage(stages, vocabulary):
    rows = [(i, r.text) for i, r in rows_of(stages[4]).items()]
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert collected(stages[5], *columns) == expected_pieces(rows, vocabulary("byte_bpe_50k.json"))
    check_sequences(stages[5].collect())


def test_run_gives_the_last_stage(spark, stages):
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert collected(corpus_pipeline.run(spark, SMOKE), *columns) == collected(stages[5], *columns)


def test_stages_bear_odd_rows(spark, odd_rows):
    docs = odd_rows.selectExpr("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs, docs.limit(0)):
            out = materialize(stage(spark, frame, SMOKE), name)
            assert out.count() <= frame.count() or name == "best_fit_packing"
            if name != "best_fit_packing":
                assert out.dtypes == docs.dtypes
    assert {r.doc_id for r in corpus_pipeline.exact_duplicates(spark, docs, SMOKE).collect()} == {1, 3, 5, 6, 8, 10, 11}


def test_one_row_of_a_group_stays_whatever_its_ids(spark):
    near = " ".join(f"w{k}" for k in range(60))
    rows = [(None, "t"), (None, "t"), (None, "u u"), (None, "u  u"), (2, "x"), (2, "y"), (1, "x"), (2, "y"), (3, None), (3, ""),
            (7, near + " end"), (7, near), (None, near), (None, "b " + near.upper()), (None, "z"), (4, " "), (4, "\n")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")

    def ids(frame):
        return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)

    exact = corpus_pipeline.exact_duplicates(spark, docs, SMOKE)
    assert [(i, (t or "").split()) for i, t in ids(exact)] == [(i, (t or "").split()) for i, t in sorted(
        [(None, "t"), (None, "u u"), (None, "b " + near.upper()), (None, "z"), (1, "x"), (2, "y"), (3, None),
         (4, " "), (7, near), (7, near + " end")], key=repr)]
    got = [(i, (t or "").split()) for i, t in ids(corpus_pipeline.near_duplicates(spark, docs, SMOKE))]
    assert [g for g in got if len(g[1]) > 9] in ([(7, near.split())], [(7, (near + " end").split())])
    assert [g for g in got if g[1] and len(g[1]) < 9] == [(1, ["x"]), (2, ["y"]), (None, ["t"]), (None, ["u", "u"]), (None, ["z"])]
    # No words: rows of one id and text (null: empty) are one document, the two blank ones of id 4 differ.
    assert sorted(g[0] for g in got if not g[1]) == [3, 4, 4]


def test_many_rows_without_an_id(spark, documents):
    rows, frame = documents
    nameless = frame.selectExpr("cast(null as bigint) doc_id", "text", "lang", "source", "n_chars")
    want = {r.text for r in corpus_pipeline.exact_duplicates(spark, frame, SMOKE).collect()}
    got = corpus_pipeline.exact_duplicates(spark, nameless.union(nameless), SMOKE).collect()
    assert len(got) == len(want) and {" ".join(r.text.split()) for r in got} == {" ".join(t.split()) for t in want}
    groups = len({c for _, _, c, _ in near_groups(rows, 5)})
    assert corpus_pipeline.near_duplicates(spark, nameless.union(nameless), SMOKE).count() == groups


def test_queries_are_registered_with_one_for_each_operator():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert {"op6_exact_dedup", "op8_line_dedup", "op11_merkle_manifest", "op13_spelling_variants"} <= set(entry.oracle_sql())


def test_entry_works_without_the_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("marquee.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert not [n for n in e.queries() if n.startswith("op") or n == "pipeline"], e.queries()
assert len(e.queries()) == len(e.oracle_sql()) >= 22
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "marquee").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "marquee").parts:
            assert "marquee.llm" not in path.read_text(), path
