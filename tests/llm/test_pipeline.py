from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from helpers import documents, prose

import __spark_entry__ as entry_point
import check
import corpus_pipeline
from firmscout.llm.common import staged
from firmscout.llm.oracle import ORACLE as LLM_ORACLE

SMALL = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_every_operator_has_a_query():
    names = entry_point.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, name):
    types, found = check.spark_rows(entry_point.queries()[name](spark, SMALL))
    want_types, want = check.oracle_rows(check.database(SMALL), entry_point.oracle_sql()[name])
    assert types == want_types
    assert found == want


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    """Each stage's effect on documents planted for it; columns with odd names pass through all filters."""
    item = " ".join(prose("benchmark", 40).split())
    passage = prose("passage", 70)
    rows = [(i, prose(i, 150)) for i in range(30)]
    rows += [(100, " ".join(w.upper() + "!!" for w in prose(100, 100).split())), (101, None), (102, "too short")]
    rows += [(110 + i, " ".join(w.upper() + "!!" for w in prose(110 + i, 100).split())) for i in range(3)]
    rows += [(200, prose(1, 150)), (201, prose(2, 150).replace(" ", "  ", 3))]
    rows += [(300 + i, prose(300 + i, 80) + passage) for i in range(3)]
    rows += [(400, prose(400, 80) + " Now. " + item + " Well. " + prose(401, 80))]
    docs = documents(spark, rows, extra=True)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, str(tmp_path)))
        if name != "mixing_sources":
            assert docs.columns == columns
        kept.append({r[0] for r in docs.collect()})
        if name == "substring_dedup":
            texts = {r[0]: r[1] for r in docs.collect()}
    clean = set(range(30)) | {300, 301, 302}
    assert not kept[0] & {100, 101, 102, 110, 111, 112} and clean | {200, 201, 400} <= kept[0]
    assert kept[1] == kept[0] - {200, 201}
    assert passage in texts[300] and passage not in texts[301] and passage not in texts[302]
    assert texts[5] == prose(5, 150)
    assert kept[3] == kept[2] - {400} and kept[4] == kept[3] >= clean
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in docs.collect()}
    assert all(0 <= t <= 2 * n for n, t in taken.values()) and sum(t for _, t in taken.values()) > 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert 100 < len(rows) < 200 and {"doc_id", "taken"} <= set(rows[0].asDict())


def test_the_rest_works_without_this_package(tmp_path):
    """The entry point without the package and the pipeline still offers all other queries."""
    for name in ("firmscout", "suite", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(ROOT / name)
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('firmscout.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert 'leads' in names and 'pipeline' not in names and not any(n.startswith('op') for n in names), names\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
