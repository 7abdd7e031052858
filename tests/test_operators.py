"""Operators on small inputs made by hand: traps of the alignment rules, job states, stores, streams, host helpers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from coevo.functions import residues as R
from coevo.operators import alignment as A
from coevo.operators import couplings as C
from coevo.operators import fit, interface, jobs
from coevo.operators.store import JobStore
from coevo.plans import queries as core
from coevo.plans import roundtrips  # noqa: F401 (registers its queries with the others)
from coevo.sources import readers, shared, writers
from coevo.streaming import incoming


def rows_of(spark, seqs, names=None, ox=None):
    data = [(k, names[k] if names else f"s{k}", ox[k] if ox else k, s) for k, s in enumerate(seqs)]
    return spark.createDataFrame(data, "row_idx long, name string, ox int, seq string").withColumn("codes", R.encode(F.col("seq")))


def test_dot_of_the_query_is_no_gap(spark):
    rows = rows_of(spark, ["A.-C", "AD-C", "--DD"])
    got = {r.row_idx: (r.seq, list(r.codes)) for r in A.keep_query_columns(rows).collect()}
    assert got == {0: ("A.C", [1, 0, 2]), 1: ("ADC", [1, 3, 2]), 2: ("--D", [0, 0, 3])}
    by_code = {r.row_idx: list(r.codes) for r in A.keep_query_columns(rows.drop("seq")).collect()}
    assert by_code[1] == [1, 2]


def test_signs_and_codes_filter_alike(spark):
    rows = rows_of(spark, ["AC-.", "acDX", "----", "AC1D", "A--C", "éCDE"])
    for f in (A.drop_invalid, lambda d: A.drop_gapped(d, 0.5)):
        assert {r.row_idx for r in f(rows).collect()} == {r.row_idx for r in f(rows.drop("seq")).collect()}
    assert {r.row_idx for r in A.drop_invalid(rows).collect()} == {0, 2, 4}


def plain_hits(seqs, names, ox, mask):
    """The rule by plain loops, columns outside the mask counting as agreeing."""
    width = len(seqs[0])
    same = lambda a, b: (sum(seqs[a][k] == seqs[b][k] for k in mask) + width - len(mask)) / width
    identity = [round(same(k, 0), 3) for k in range(len(seqs))]
    best = {}
    for k in range(len(seqs)):
        if ox[k] is not None and (ox[k] not in best or identity[k] > identity[best[ox[k]]]):
            best[ox[k]] = k
    head = names[0].split("/")[0]
    later = [k for k in range(1, len(seqs)) if head in names[k]]
    paralogs = [k for k in range(len(seqs)) if later and ox[k] == ox[later[0]] and identity[k] < 0.9]
    if not paralogs:
        return identity, list(range(len(seqs)))
    return identity, sorted({0} | {k for k in best.values() if max(same(k, p) for p in paralogs) < identity[k] + 0.02})


@pytest.mark.parametrize("mask", [list(range(20)), [0, 1, 2, 3, 10, 11, 12], [5]])
def test_paralogs_are_held_to_the_mask(spark, mask):
    r = np.random.default_rng(len(mask))
    letters = np.array(list("ACDE"))
    base = r.integers(0, 4, 20)
    seqs = ["".join(letters[np.where(r.random(20) < rate, r.integers(0, 4, 20), base)]) for rate in [0, *r.random(39)]]
    names = ["q/1"] + ["xq/2" if k in (7, 9) else f"s{k}" for k in range(1, 40)]
    ox = [3] + [None if k % 11 == 0 else 5 if k in (7, 9) else int(x) for k, x in enumerate(r.integers(1, 12, 39), 1)]
    identity, want = plain_hits(seqs, names, ox, mask)
    m = spark.createDataFrame([(k,) for k in mask], "pos int")
    rows = A.query_identity(rows_of(spark, seqs, names, ox), m)
    assert [x.query_identity for x in rows.orderBy("row_idx").collect()] == identity
    assert sorted(x.row_idx for x in A.reciprocal_hits(rows, mask=m).collect()) == want
    for block in (3, 1024):
        got = {x.row_idx: x.identity for x in A.closest(rows, rows.where("row_idx IN (7, 9)"), m, block).collect()}
        assert len(got) == 40 and got[7] == 1.0
    alone = rows.withColumn("name", F.when(F.col("row_idx") == 0, "q/1").otherwise("other"))
    assert A.reciprocal_hits(alone, mask=m).count() == 40


def test_stored_alignment_and_pairs(spark, tmp_path):
    a = rows_of(spark, ["AAAA", "AACC", "AAAC", "CCCC", "AAAA"], ox=[1, 7, 7, 9, None]).withColumn("weight", F.lit(0.5))
    b = rows_of(spark, ["DD", "DE", "ED", "DD"], ox=[1, 9, 7, 8])
    for rows, name in ((a, "a"), (b, "b")):
        writers.alignment(rows, str(tmp_path / name), lengths=[4], saved_columns=[0, 2])
    x, meta = readers.stored_alignment(spark, str(tmp_path / "a"))
    assert meta == {"lengths": [4], "saved_columns": [0, 2], "beff": 2.0}
    assert {r.row_idx for r in x.collect()} == {0, 1, 2, 3} and "weight" in x.columns
    y, meta = readers.stored_alignment(spark, str(tmp_path / "b"))
    assert meta["beff"] is None
    got = [(r.row_idx, r.ox, "".join(c)) for r in A.pair_stored(x, y).withColumn("s", R.decode(F.col("codes"))).collect() for c in [r.s]]
    assert sorted(got) == [(0, None, "AAAADD"), (1, 7, "AAACED"), (2, 9, "CCCCDE")]
    with pytest.raises(FileNotFoundError):
        readers.stored_alignment(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        readers.alignment(spark, str(tmp_path / "none.fasta"))
    writers.codes_npy(b, str(tmp_path / "b.npy"))
    assert np.load(tmp_path / "b.npy").tolist() == [[3, 3], [3, 4], [4, 3], [3, 3]]
    assert A.saved_columns([0, 2], [1], 4) == [0, 2, 5]
    assert readers.record(spark, "p", "ACD", "p OS=Mus GN=a b").first().gn == "a b"


def test_description_parts(spark):
    lines = ["x OS=Homo s OX=9606 GN=ab cd PE=1 SV=2", "OS=Mus SV=1 more text", "OS=A GN=g OX=5", "none", "OS= OX=7", "OS=B OX=x"]
    df = spark.createDataFrame([(k, s) for k, s in enumerate(lines)], "k int, d string").select("k", R.describe(F.col("d")).alias("p")).select("k", "p.*").orderBy("k")
    assert [tuple(r)[1:] for r in df.collect()] == [
        ("Homo s", 9606, "ab cd", "1", "2"), ("Mus", None, None, None, "1 more text"), ("A", None, "g OX=5", None, None),
        (None,) * 5, (None, 7, None, None, None), ("B", None, None, None, None)]


def test_scores_from_pandas_and_small_measures(spark):
    df = pd.DataFrame({"res1": [0, 0, 1], "res2": [0, 1, 1], "score": [1.0, 0.5, 2.0]})
    assert sorted(map(tuple, readers.couplings(spark, df).collect())) == [(1, 1, 1.0), (1, 2, 0.5), (2, 2, 2.0)]
    s = readers.couplings(spark, np.array([[1.0, 2.0], [3.0, 4.0]]))
    assert [r.score for r in C.by_position(s).collect()] == [1.0, 2.0, 3.0, 4.0]
    assert sorted(r.pos for r in C.positions(s).collect()) == [1, 2]
    values = [0.0, 1.0, -0.1, 65504.0, 65519.0, 65520.0, 1e-7, 5.960464477539063e-08, 3.1e-8, 1 / 3, 2049.0, 2051.0]
    got = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").select("k", C.half_precision(F.col("v")).alias("h")).orderBy("k").collect()
    with np.errstate(over="ignore"):
        assert [r.h for r in got] == np.array(values).astype(np.float16).astype(float).tolist()


def test_pair_frequencies_in_blocks(spark):
    r = np.random.default_rng(3)
    codes, w = r.integers(0, 4, (50, 7)), r.random(50)
    rows = spark.createDataFrame([(c.tolist(), float(x)) for c, x in zip(codes, w)], "codes array<int>, weight double")
    want = {}
    for c, x in zip(codes, w / w.sum()):
        for i in range(7):
            for j in range(7):
                if i != j:
                    k = (i + 1, j + 1, int(c[i]), int(c[j]))
                    want[k] = want.get(k, 0) + x
    for args in ((64, 4096), (3, 10)):
        got = {tuple(x)[:4]: x.f for x in C.pair_frequencies(rows, *args).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_interface_at_the_cutoff(spark):
    """Distances on both sides of 8.0 and exactly 8.0."""
    face = spark.createDataFrame([(1, 1, 7.9), (1, 2, 8.0), (2, 2, 8.1), (3, 9, 7.0)], "res_a int, res_b int, dist double")
    s = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.9), (2, 2, 0.9), (3, 3, 0.9), (2, 1, 0.1), (3, 9, 0.1)], "pos1 int, pos2 int, score double")
    kinds = {(r.pos1, r.pos2): r.kind for r in interface.classify(s, face, 0.5, 8.0).collect()}
    assert kinds == {(1, 1): "TP", (1, 2): "negative", (2, 2): "FP", (3, 3): "FP", (2, 1): "negative", (3, 9): "negative"}
    mono = {(r.pos1, r.pos2): r.kind for r in interface.monomer_classify(s, face, 0.5, 8.0).collect()}
    assert mono == {(1, 1): "TP", (2, 2): "FP", (3, 3): "negative", (2, 1): "negative"}
    row = interface.benchmark_index(s.where("score > 0.5"), s, face, 8.0).first()
    assert (row.tp_baseline, row.tp_query, row.tpr_full, row.tpr) == (2, 1, 0.5, 0.25)
    with pytest.raises(ValueError):
        interface.require_hits(interface.benchmark_index(s.where("score < 0.2 AND pos1 = 2"), s, face, 8.0))


def test_job_store(tmp_path):
    one = JobStore(str(tmp_path / "jobs.db"), 'odd "name"', "alignments")
    two = JobStore(str(tmp_path / "jobs.db"), 'odd "name"', "alignments")
    assert one.insert(["a", "b", "c"]) == 3 and two.insert(["c", "d"], None) == 1
    got, rest = one.claim(2, "x", 1.0), two.claim(5, "y", 2.0)
    assert [k for _, k, _ in got] == ["a", "b"] and [k for _, k, _ in rest] == ["c"]
    one.finish([(1, True), (2, False)])
    assert two.claim(5, "z", 3.0, null_too=True) == [(2, "b", 3), (4, "d", 1)]
    two.finish([(2, False), (1, False)])
    state = dict(one.db.execute(f"SELECT pid, status FROM {one.table}"))
    assert state == {"a": 0, "b": 4, "c": 1, "d": 1}
    one.add_column("note", "TEXT")
    one.add_column("note", "TEXT")
    assert one.db.execute(f"SELECT note FROM {one.table}").fetchone() == (None,)


def test_scheduler_and_progress(spark, tmp_path):
    tasks = spark.createDataFrame([(1, 1, "7", 1.0), (2, 3, "7", 1.0), (3, 0, "7", None), (4, 1, "8", 1.0), (5, None, None, None)], "id int, status int, job_id string, claimed_at double")
    runs = spark.createDataFrame([("7", "RUNNING"), ("8", "RUNNING")], "job_id string, status string")
    seen = spark.createDataFrame([("7", "CANCELLED by 5"), ("8", "COMPLETED")], "job_id string, state string")
    assert sorted((r.id, r.status) for r in jobs.sync_tasks(tasks, runs, seen).collect()) == [(1, 2), (2, 4)]
    assert {r.job_id: r.status for r in jobs.sync_states(runs, seen).collect()} == {"7": "CANCELLED", "8": "COMPLETED"}
    assert jobs.counts(tasks).first() == (5, 5, 1) and jobs.counts(tasks.limit(0)).first() == (0, 0, 0)
    assert not jobs.is_complete(tasks) and jobs.is_complete(tasks.where("id = 3"))
    assert {r.id for r in jobs.claimable(tasks, True).collect()} == {5} and jobs.claimable(tasks, False).isEmpty()
    assert jobs.runs_to_submit(3, 5, 9) == 2 and jobs.runs_to_submit(7, 5, 9) == 0 == jobs.runs_to_submit(0, 5, 0)
    table = jobs.cron_lines("1 * * * * other\n", "go", "*/5 * * * *")
    assert jobs.cron_lines(table, "go", "*/5 * * * *") == table and jobs.cron_lines(table, "go", None) == "1 * * * * other\n"
    assert [r.priority for r in jobs.priorities(tasks).orderBy("id").collect()] == [-1, -2, -3, -4, -5]


def test_events_and_buffer(spark, tmp_path):
    now, path = [0.0], str(tmp_path / "events")
    with writers.ResultBuffer(spark, path, "pid string, status int, seq int", most=3, seconds=10, clock=lambda: now[0]) as buffer:
        buffer.add("a", 1, 1)
        now[0] = 11.0
        buffer.add("a", 0, 2)
        assert spark.read.parquet(path).count() == 2
        buffer.add("b", 4, 3)
    assert {r.pid: r.status for r in jobs.latest(spark.read.parquet(path), "pid", "seq").collect()} == {"a": 0, "b": 4}


def test_fetch_and_search(spark, tmp_path):
    pids = spark.createDataFrame([("P1",), ("P2",)], "pid string")

    def load(pid):
        if pid == "P2":
            raise OSError("no route")
        return "ID   P1\nSQ   SEQUENCE\n     AC DE\n//\n"

    got = {r.pid: (r.status, r.seq, r.error) for r in readers.fetch(pids, load, 2).collect()}
    assert got == {"P1": (-1, "ACDE", None), "P2": (4, None, "OSError: no route")}
    assert {r.status for r in readers.fetch_local(pids, str(tmp_path)).collect()} == {4}
    assert readers.search(pids, ["test", "-n", "{pid}"]).count() == 2
    with pytest.raises(Exception, match="ended with 1"):
        readers.search(pids, ["test", "{pid}", "=", "P1"]).collect()


def test_structure_models_and_alternates(spark, tmp_path):
    line = lambda alt, icode, x: f"ATOM      1  CA {alt}ALA A   5{icode}   {x:8.3f}{0:8.3f}{0:8.3f}"
    (tmp_path / "m.pdb").write_text("\n".join(["MODEL 1", line("A", " ", 1), line("B", " ", 2), line(" ", "C", 3), "ENDMDL", "MODEL 2", line("A", "D", 9), "ENDMDL", ""]))
    assert sorted((r.res, r.icode, r.x) for r in readers.atoms(spark, str(tmp_path / "m.pdb"), "A").collect()) == [(5, "", 1.0), (5, "C", 3.0)]


def test_arrivals(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    run = lambda: incoming.run_arrivals(spark, source, "pair string, x int", lambda d: d.withColumn("y", F.col("x") * 2), target, str(tmp_path / "check"), once=True).awaitTermination()
    spark.createDataFrame([("a", 1), ("b", 2), ("a", 1)], "pair string, x int").write.mode("append").parquet(source)
    run()
    assert sorted((r.pair, r.y) for r in spark.read.parquet(target).collect()) == [("a", 2), ("b", 4)]
    spark.createDataFrame([("b", 5), ("c", 3)], "pair string, x int").write.mode("append").parquet(source)
    run()
    assert sorted((r.pair, r.y) for r in spark.read.parquet(target).collect()) == [("a", 2), ("b", 4), ("c", 6)]


def test_fit_in_parts_and_optimizers():
    r = np.random.default_rng(5)
    codes, w = r.integers(0, 3, (40, 5)), r.random(40)
    whole, parts = fit.Codes(codes, 3), fit.Codes(codes, 3, most_bytes=4000)
    assert whole.held and parts.held is None
    x = r.standard_normal(3 + 5 * 9) * 0.1
    x[3 + 2 * 9:3 + 3 * 9] = 0
    a, b = (fit.objective(c, w, 2, 3, 0.01, 0.01)(x) for c in (whole, parts))
    assert abs(a[0] - b[0]) < 1e-12 and np.abs(a[1] - b[1]).max() < 1e-12
    best = fit.fit_site(codes, w, 1, 3, most=500, tolerance=1e-6)[0]
    slow = fit.fit_site(codes, w, 1, 3, most=8000, tolerance=1e-3, optimizer="rmsprop")[0]
    assert np.abs(best - slow).max() < 0.2


def test_unconverged_pairs_and_files(spark, tmp_path):
    params = spark.createDataFrame([("a", 0, True), ("a", 1, False), ("b", 0, True)], "pair string, site int, converged boolean")
    assert {r["pair"] for r in fit.require_converged(params).collect()} == {"b"}
    assert "plm" in fit.SCORERS
    writers.project_config(str(tmp_path / "p.yml"), {"couple": {"method": "plm", "k": 1}})
    writers.project_config(str(tmp_path / "q.yml"), {"couple": {"k": 2}})
    assert readers.yaml_config(str(tmp_path / "p"), str(tmp_path / "q.yml")) == {"couple": {"method": "plm", "k": 2}}
    with pytest.raises(FileExistsError):
        writers.project_config(str(tmp_path / "p.yml"), {})
    writers.submit_script(str(tmp_path / "s.sh"), "run it", {"time": "1:00"}, ["java"])
    assert (tmp_path / "s.sh").read_text() == "#!/bin/bash\n#SBATCH --time=1:00\nmodule load java\nrun it\n"


def test_stored_tables_are_deleted(spark):
    df = shared.stored(spark.range(3), "x")
    assert df.count() == 3
    shared.delete_tables(spark)
    with pytest.raises(Exception):
        df.count()


def test_from_files_to_scores(spark, tmp_path):
    """Two alignments in which one column of the first decides one of the second: that pair scores highest."""
    from coevo.plans import project

    r = np.random.default_rng(12)
    letters = np.array(list("ACDE"))
    a, b = letters[r.integers(0, 4, (120, 6))], letters[r.integers(0, 4, (120, 5))]
    b[:, 3] = a[:, 1]
    for name, rows in (("a", a), ("b", b)):
        lines = [f">{name}{k} x OS=Some one OX={k + 1}\n{''.join(s)}" for k, s in enumerate(rows)]
        (tmp_path / f"{name}.fasta").write_text("\n".join(lines) + "\n>bad OS=x OX=999\n" + "1" * rows.shape[1] + "\n")
        assert project.main(["align", str(tmp_path / f"{name}.fasta"), str(tmp_path / name)]) == 0
    assert readers.stored_alignment(spark, str(tmp_path / "a"))[1] == {"lengths": [6], "saved_columns": list(range(6)), "beff": None}
    (tmp_path / "o.yml").write_text("couple:\n  reweighting:\n    enabled: false\n")
    assert project.main(["couple", str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "scores"), "a-b", "--config", str(tmp_path / "o.yml")]) == 0
    scores = readers.stored_scores(spark, str(tmp_path / "scores"), "a-b")
    best = C.top_k(C.interchain(scores, 6), 1).first()
    assert scores.count() == 121 and (best.pos1, best.pos2) == (2, 4)


def test_distances_of_some_pairs(spark):
    """As of all pairs: off the surface or without atoms there is no row, and a residue may owe its place to one that has no score."""
    rng = np.random.default_rng(3)
    sides = [[(int(r), *map(float, p)) for r, p in zip(np.repeat(np.arange(1, 13), 4), rng.uniform(0, 22, (48, 3)))] for _ in "ab"]
    a, b = [spark.createDataFrame(s, "res int, x double, y double, z double") for s in sides]
    pairs = [(i, j) for i in (1, 2, 3, 5, 8, 13) for j in range(1, 8)]
    got = {tuple(r) for r in interface.distances_of(spark.createDataFrame(pairs * 2, "res_a int, res_b int"), a, b, 3.0).collect()}
    near = np.sqrt(((np.array(sides[0])[:, None, 1:] - np.array(sides[1])[None, :, 1:]) ** 2).sum(-1)).reshape(12, 4, 12, 4).min((1, 3))
    on_a, on_b = (near < 3).any(1), (near < 3).any(0)
    want = {(i, j, round(float(near[i - 1, j - 1]), 1)) for i, j in pairs if i < 13 and on_a[i - 1] and on_b[j - 1]}
    assert got == want and 0 < len(want) < 35
    assert any(on_a[i - 1] and not (near[i - 1, :7] < 3).any() for i in (1, 2, 3, 5, 8))


@pytest.mark.parametrize("name", ["topk_tpr", "classify_pairs", "monomer_benchmark", "true_positive_count", "benchmark_index", "monomer_pairs"])
def test_scored_pairs_alone_are_compared(spark, monkeypatch, name):
    """Distances of all pairs grow with the square of the residues; a query of some scores does without them."""
    table = spark.createDataFrame([(i, j, (i * 7 + j * 5) % 11 / 1000 - 0.005) for i in range(1, 49) for j in range(1, 49)], "pos1 int, pos2 int, score double")
    monkeypatch.setattr(core, "scored", lambda *_: table)
    monkeypatch.setattr(core, "plain_scores", lambda *_: table.withColumn("score", -F.col("score")))
    monkeypatch.delattr(interface, "distances")
    assert core.QUERIES[name](spark, "/root/testdata/sf0.001").collect()


def test_distances_by_blocks(spark):
    """Residues of one to many atoms, over several blocks, atoms without a place, and decimals that lie on the edge."""
    rng = np.random.default_rng(5)
    sizes = [1, 2, 5, 9, 3000] + [4] * 1500
    a = [(f"r{r}", *map(float, p)) for r, p in zip(np.repeat(np.arange(len(sizes)), sizes), rng.uniform(-60, 60, (sum(sizes), 3)))]
    b = [(int(r), *map(float, p)) for r, p in zip(np.repeat(np.arange(40), 3), rng.uniform(-60, 60, (120, 3)))]
    near = lambda x, y: np.sqrt(((np.array([t[1:] for t in x])[:, None] - np.array([t[1:] for t in y])[None]) ** 2).sum(-1))
    d = np.minimum.reduceat(np.minimum.reduceat(near(a, b), np.cumsum([0, *sizes[:-1]]), 0), np.arange(0, 120, 3), 1)
    on_a, on_b = (d < 3).any(1), (d < 3).any(0)
    want = {(f"r{i}", int(j), round(float(d[i, j]), 1)) for i in np.nonzero(on_a)[0] for j in np.nonzero(on_b)[0]}
    lost = [("r0", None, 0.0, 0.0), ("r1", float("nan"), 0.0, 0.0), ("r2", float("inf"), 0.0, 0.0), ("gone", None, None, None)]
    left, right = spark.createDataFrame(a + lost, "res string, x double, y double, z double"), spark.createDataFrame(b, "res int, x double, y double, z double")
    got = interface.distances(left, right, 3.0)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 1000
    edge = interface.least_distances(np.array([[[300.0, 0, 0]], [[-300.0, 0, 0]]]), np.array([[[300.25, 0, 0]], [[300.75, 0, 0]], [[300.0, 0, 0]]]))
    assert edge.tolist() == [[0.2, 0.8, 0.0], [600.2, 600.8, 600.0]]
