"""Readers and writers on small files, fit kernels against finite differences, pure helpers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from coevo.functions import residues as R
from coevo.operators import alignment as A
from coevo.operators import couplings as C
from coevo.operators import fit, jobs
from coevo.plans import roundtrips
from coevo.sources import readers, writers


def test_fasta_and_stockholm(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">q/1 x OS=Homo s OX=9606 GN=ab PE=1 SV=2\nAC-\nDX\n>s2 OS=Mus\nac.dd\n")
    rows = readers.alignment(spark, str(tmp_path / "a.fasta")).orderBy("row_idx").collect()
    assert [(r.row_idx, r.id, r.seq, r.os, r.ox, r.gn, r.sv) for r in rows] == [(0, "q/1", "AC-DX", "Homo s", 9606, "ab", "2"), (1, "s2", "ac.dd", "Mus", None, None, None)]
    (tmp_path / "b.sto").write_text("# STOCKHOLM 1.0\n#=GS q DE OS=Homo OX=9606\nq AC\nr DE\n\nq -F\nr GG\n//\n")
    rows = readers.alignment(spark, str(tmp_path / "b.sto")).orderBy("row_idx").collect()
    assert [(r.name, r.seq, r.ox) for r in rows] == [("q", "AC-F", 9606), ("r", "DEGG", None)]
    with pytest.raises(NotImplementedError):
        readers.alignment(spark, "x.doc")
    (tmp_path / "e.fasta").write_text("\n")
    with pytest.raises(ValueError):
        readers.alignment(spark, str(tmp_path / "e.fasta"))


def test_codes_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, None, "AC-.yX"), (1, 7, "acDEFG"), (2, 7, "AC-DEF")], "row_idx long, ox int, seq string").withColumn("codes", R.encode(F.col("seq")))
    got = {r.row_idx: (list(r.codes), r.s) for r in df.select("*", R.decode(F.col("codes")).alias("s")).collect()}
    assert got[0] == ([1, 2, 0, 0, -1, 21], "AC--yX")
    writers.alignment(df, str(tmp_path / "aln"))
    back = {r.row_idx: r for r in spark.read.parquet(str(tmp_path / "aln" / "rows")).collect()}
    assert back[2].rank_in_species == 1 and back[1].rank_in_species == 2 and back[0].is_query
    writers.fasta(df, str(tmp_path / "text"))
    again = readers.fasta(spark, str(tmp_path / "text"))
    assert sorted(r.seq for r in again.collect()) == ["AC--yX", "AC-DEF", "acDEFG"]
    with pytest.raises(Exception):
        writers.alignment(df, str(tmp_path / "aln"))


def test_score_files(spark, tmp_path):
    (tmp_path / "s.csv").write_text("res1,res2,score\n0,1,0.5\n0,2,0.25\n1,2,x\n")
    got = {(r.pos1, r.pos2): r.score for r in readers.couplings(spark, str(tmp_path / "s.csv")).collect()}
    assert got[1, 1] == 0.5 and got[1, 2] == got[2, 1] == 0.25 and got[2, 2] is None
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        readers.coupling_csv(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "p.txt").write_text("1 A 2 C 0 0.5\n 1 A 3 D 0 -1e-2\n")
    assert sorted(map(tuple, readers.coupling_text(spark, str(tmp_path / "p.txt")).collect())) == [(1, 2, 0.5), (1, 3, -0.01)]
    m = np.arange(9.0).reshape(3, 3)
    np.save(tmp_path / "m.npy", m)
    df = readers.couplings(spark, str(tmp_path / "m.npy"))
    assert df.count() == 9
    writers.npy(df, str(tmp_path / "n.npy"))
    assert (np.load(tmp_path / "n.npy") == m).all()


def test_other_readers(spark, tmp_path):
    (tmp_path / "P1.txt").write_text("ID   P1_X  Reviewed;\nAC   P1; Q2;\nOX   NCBI_TaxID=9606;\nSQ   SEQUENCE   4 AA;\n     AC DE\n//\n")
    assert [tuple(r) for r in readers.swissprot(spark, str(tmp_path / "P1.txt")).collect()] == [("P1_X", "P1", 9606, "ACDE")]
    pids = spark.createDataFrame([("P1",), ("P2",)], "pid string")
    assert {r.pid: (r.status, r.seq) for r in readers.fetch_local(pids, str(tmp_path)).collect()} == {"P1": (-1, "ACDE"), "P2": (4, None)}
    (tmp_path / "x.pdb").write_text(f"{'ATOM':<6}{1:>5}  CA  ALA A{5:>4}    {1.5:8.3f}{-2:8.3f}{3:8.3f}\n{'ATOM':<6}{2:>5}  P    DA A{6:>4}    {0:8.3f}{0:8.3f}{0:8.3f}\n")
    assert [tuple(r) for r in readers.atoms(spark, str(tmp_path / "x.pdb"), "A").collect()] == [("A", 5, "", "CA", 1.5, -2.0, 3.0)]
    writers.flat_binary(np.array([[1, 2], [0, 20]]), np.array([0.5, 1.0]), str(tmp_path / "bin"))
    assert [(list(r.codes), r.weight) for r in readers.flat_binary(spark, str(tmp_path / "bin")).orderBy("row_idx").collect()] == [([1, 2], 0.5), ([0, 20], 1.0)]
    assert readers.merged_config({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 5}, "d": {"e": 1}}) == {"a": {"b": 5, "c": 2}, "d": {"e": 1}}


def small():
    r = np.random.default_rng(1)
    codes = r.integers(0, 3, (20, 4))
    codes[:, 3] = codes[:, 0]
    return codes, r.uniform(0.5, 1, 20)


def test_gradient_and_minimum():
    codes, weights = small()
    f = fit.objective(codes, weights, 1, 3, 0.01, 0.01)
    x = np.random.default_rng(2).standard_normal(3 + 4 * 9) * 0.1
    _, g = f(x)
    for k in range(len(x)):
        e = np.zeros_like(x)
        e[k] = 1e-6
        assert abs((f(x + e)[0] - f(x - e)[0]) / 2e-6 - g[k]) < 1e-6
    a, good = fit.fit_site(codes, weights, 1, 3, most=500, tolerance=1e-6)
    b, _ = fit.fit_site(codes, weights, 1, 3, most=6000, tolerance=1e-5, optimizer="nadam")
    assert good and np.abs(a - b).max() < 1e-2 and not a[1].any()
    with pytest.raises(ValueError):
        fit.objective(codes - 1, weights, 1, 3, 0.01, 0.01)


def test_scores_in_spark_like_numpy(spark):
    codes, weights = small()
    rows = spark.createDataFrame([("p", c.tolist(), float(w)) for c, w in zip(codes, weights)], "pair string, codes array<int>, weight double")
    got = fit.scores_of(fit.fit_sites(rows, blocks=2, q=3), q=3).collect()
    j = np.stack([fit.gauge(fit.fit_site(codes, weights, s, 3)[0]) for s in range(4)])
    want = fit.corrected(fit.norms(j))
    assert len(got) == 16 and all(abs(r.score - want[r.pos1 - 1, r.pos2 - 1]) < 1e-9 for r in got)
    assert np.abs(want - want.T).max() < 1e-12 and max(got, key=lambda r: r.score).pos1 in (1, 4)
    assert np.abs(fit.gauge(j).mean(-1)).max() < 1e-12


def test_weights_do_not_depend_on_blocks(spark):
    r = np.random.default_rng(4)
    base = r.integers(0, 5, (15, 20))
    codes = np.where(r.random((90, 20)) < 0.1, r.integers(0, 5, (90, 20)), base[r.integers(0, 15, 90)])
    rows = spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(codes)], "row_idx long, codes array<int>")
    want = {k: int((10 * (codes == c).sum(1) >= 8 * 20).sum()) for k, c in enumerate(codes)}
    for block in (1024, 16):
        assert {x.row_idx: x.n for x in A.neighbour_counts(rows, 8, block).collect()} == want


def test_pure_helpers():
    assert jobs.id_range((0.25, 0.75), 8) == (3, 7) and jobs.id_range((-1, 2), 8) == (1, 9)
    assert R.quote_identifier("a`b") == "`a``b`"
    assert abs(C.spearman_p(0.5, 20) - 0.0247) < 5e-4 and C.spearman_p(1.0, 5) == 0.0
    with pytest.raises(ValueError):
        C.top_k(None, 0)


def test_residue_numbers_come_again(spark, tmp_path):
    """Vectors 7 and 10007 share chain and residue number, in one file of the input; both are atoms."""
    rows = [(i, [i / 1000 + 0.001 * k for k in range(64)], 2) for i in (7, 8)] + [(10_007, [0.5] * 64, 2), (20_007, [0.25] * 64, 3)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted((r.chain, r.res, r.x) for r in roundtrips.structure_scan(spark, str(tmp_path)).collect())
    assert got == [("C", 7, 0.28), ("C", 7, 20.0), ("C", 8, 0.32)]
