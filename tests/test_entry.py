"""The driver's contract."""

import importlib
import sys


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_corpus_operators(monkeypatch):
    import __spark_entry__ as entry

    for name in [n for n in sys.modules if n.startswith("contigforge.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "contigforge.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    bare = importlib.reload(entry)
    names = set(bare.queries())
    assert "metabin_stats" in names and "pipeline" not in names and not any(n.startswith("op1_") for n in names)
    monkeypatch.undo()
    importlib.reload(entry)


def test_commands():
    from contigforge import cli

    parser = cli.parser()
    assert parser.parse_args(["kmers", "--fasta", "a", "--output", "b"]).size == 5
    a = parser.parse_args(["binning", *sum(([f"--{n}", "x"] for n in ("kmers", "coverages", "gc-content", "markers", "taxonomy", "output-binning", "output-main")), [])])
    assert (a.completeness, a.purity, a.cov_stddev_limit, a.gc_stddev_limit, a.clustering_method) == (20.0, 95.0, 25.0, 5.0, "dbscan")
