"""Staged one-to-one pairing properties (J18): one-to-one, maximal per key,
stages disjoint, hot keys split over salt buckets give the same counts."""

from collections import Counter

from pyspark.sql import functions as F

from ledgerlens.operators import reconcile as RC
from ledgerlens.operators.skew import global_rank, ranked_within


def _frames(spark):
    left = [(i, f"c{i % 3}", f"p{i % 4}" if i % 5 else None, f"k{i % 2}") for i in range(1, 41)]
    right = [(100 + j, f"c{j % 3}", f"p{j % 6}" if j % 7 else None, f"k{j % 3}") for j in range(1, 31)]
    l = spark.createDataFrame(left, "src_id long, cliente_id string, numero_proposta string, numero_contrato string")
    r = spark.createDataFrame(right, "id long, cliente_id string, numero_proposta string, numero_contrato string")
    return left, right, l, r


def test_pairing_is_one_to_one_and_maximal(spark):
    left, right, l, r = _frames(spark)
    stages = [("s1", ["cliente_id", "numero_proposta"]), ("s2", ["cliente_id", "numero_contrato"])]
    pairs = RC.staged_pairing(l, r, stages).collect()
    lids = [p.src_id for p in pairs]
    rids = [p.id for p in pairs]
    assert len(lids) == len(set(lids)) and len(rids) == len(set(rids))
    # stage 1 count = sum over keys of min(m, n), NULL keys excluded
    lk = Counter((c, p) for _, c, p, _ in left if p is not None)
    rk = Counter((c, p) for _, c, p, _ in right if p is not None)
    expect1 = sum(min(n, rk[k]) for k, n in lk.items() if k in rk)
    assert sum(1 for p in pairs if p.etapa == 1) == expect1


def test_hot_key_split_matches_plain_rank(spark):
    rows = [(i * 7919 % 100_003, "hot" if i % 3 else f"k{i % 50}") for i in range(1, 2001)]
    df = spark.createDataFrame(rows, "id long, key string").repartition(5)
    by_key = {}
    for i, key in sorted(rows):
        by_key.setdefault(key, []).append(i)
    want = {(key, i): n for key, ids in by_key.items() for n, i in enumerate(ids, 1)}
    for buckets in (None, 2, 8, 300):
        got = ranked_within(df, ["key"], "id", buckets=buckets, hot_threshold=10)
        assert {(r.key, r.id): r.rn for r in got.collect()} == want


def test_pairs_do_not_depend_on_key_size(spark):
    left, right, l, r = _frames(spark)
    stages = [("s1", ["cliente_id", "numero_proposta"]), ("s2", ["numero_contrato"]), ("s3", ["cliente_id"])]
    plain = {tuple(p) for p in RC.staged_pairing(l, r, stages).collect()}
    split = {tuple(p) for p in RC.staged_pairing(l, r, stages, hot_threshold=2).collect()}
    assert plain == split and len(plain) > 20
    one = spark.createDataFrame([(i, "k") for i in (3, 5, 64, 65, 128)], "src_id long, numero_proposta string")
    other = spark.createDataFrame([(i, "k") for i in range(1, 6)], "id long, numero_proposta string")
    pairs = RC.staged_pairing(one, other, [("s", ["numero_proposta"])], hot_threshold=2).collect()
    assert sorted((p.src_id, p.id) for p in pairs) == [(3, 1), (5, 2), (64, 3), (65, 4), (128, 5)]


def test_global_rank_is_the_global_order(spark):
    df = spark.createDataFrame([(i * 7919 % 100_003,) for i in range(5000)], "k long").repartition(7)
    want = {k: n for n, k in enumerate(sorted(r.k for r in df.collect()), 1)}
    assert {r.k: r.rn for r in global_rank(df, "k", buckets=16).collect()} == want
    assert global_rank(df.limit(0), "k").count() == 0


def test_pairing_with_a_hot_key(spark):
    """One key holds a third of each side: it is ranked over salt buckets and
    still pairs exactly min(m, n) rows, one-to-one."""
    n = 900
    left = [(i, "HOT" if i % 3 == 0 else f"p{i}") for i in range(n)]
    right = [(10_000 + j, "HOT" if j % 3 == 0 else f"p{j * 2}") for j in range(n // 2)]
    l = spark.createDataFrame(left, "src_id long, numero_proposta string")
    r = spark.createDataFrame(right, "id long, numero_proposta string")
    stages = [("s1", ["numero_proposta"])]
    pairs = RC.staged_pairing(l, r, stages, hot_threshold=50, salt_buckets=4).collect()
    lk = Counter(k for _, k in left)
    rk = Counter(k for _, k in right)
    expect = sum(min(c, rk[k]) for k, c in lk.items() if k in rk)
    assert len(pairs) == expect
    assert len({p.src_id for p in pairs}) == len(pairs) == len({p.id for p in pairs})
    hot_pairs = [p for p in pairs if p.src_id % 3 == 0 and p.src_id < n]
    assert len(hot_pairs) >= min(lk["HOT"], rk["HOT"])


def test_top_k_and_latest_with_a_hot_key(spark):
    """Two-phase top-k and max(struct) latest-per-key equal brute force when
    one key holds a third of the rows."""
    from ledgerlens.operators.skew import latest_per_key, top_k_per_key
    rows = [(i, "HOT" if i % 3 == 0 else f"k{i % 50}", (i * 7919) % 1000) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, key string, v long")
    top = top_k_per_key(df, ["key"], [F.col("v").desc(), F.col("id").desc()], 5, "id", buckets=8)
    got = {}
    for r in top.collect():
        got.setdefault(r.key, []).append((r.rn, r.id))
    expect = {}
    for k in {r[1] for r in rows}:
        ranked = sorted([r for r in rows if r[1] == k], key=lambda r: (-r[2], -r[0]))[:5]
        expect[k] = [(i + 1, r[0]) for i, r in enumerate(ranked)]
    assert {k: sorted(v) for k, v in got.items()} == expect
    latest = {r.key: r.id for r in latest_per_key(df, ["key"], ["v", "id"], ["id"]).collect()}
    assert latest == {k: v[0][1] for k, v in expect.items()}


def _brute(left, right, stages):
    """Stage by stage in plain Python; (id, {key: value}) rows, ids may repeat or be None."""
    out = []
    for n, keys in enumerate(stages, 1):
        sides = []
        for rows in (left, right):
            groups = {}
            for i, k in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
                if all(k[c] is not None for c in keys):
                    groups.setdefault(tuple(k[c] for c in keys), []).append(i)
            sides.append(groups)
        found = [(a, b, n) for k in sides[0] for a, b in zip(sides[0][k], sides[1].get(k, []))]
        out += found
        gone = [{p[s] for p in found} - {None} for s in (0, 1)]
        left, right = ([r for r in rows if r[0] not in gone[s]] for s, rows in enumerate((left, right)))
    return Counter(out)


def test_repeated_and_missing_ids_leave_as_before(spark):
    """An id that comes twice leaves with all its rows; a row without an id
    stays, whatever the size of its key."""
    rows = lambda n, a, b: [(None if i % 11 == 5 else i // 2 if i % 9 == 1 else i,
                             {"x": f"x{i % a}" if i % 7 else None, "y": f"y{i % b}" if i % 5 else None}) for i in range(n)]
    left, right, stages = rows(60, 6, 5), rows(45, 8, 4), [["x", "y"], ["y"], ["x"]]
    frame = lambda rows, c: spark.createDataFrame([(i, k["x"], k["y"]) for i, k in rows], f"{c} long, x string, y string")
    named = [(f"s{n}", ks) for n, ks in enumerate(stages, 1)]
    for threshold in (200_000, 3):
        got = RC.staged_pairing(frame(left, "src_id"), frame(right, "id"), named, hot_threshold=threshold).collect()
        assert Counter((p.src_id, p.id, p.etapa) for p in got) == _brute(left, right, stages)


def test_a_stage_shuffles_each_side_once(spark):
    """Rows are dealt by key once a stage: ranks and partners come from the same tasks."""
    rows = spark.createDataFrame([(True, 1, None, "k"), (False, None, 2, "k")], "_left boolean, src_id long, id long, k string")
    met = RC._paired(rows, ["k"], "src_id", "id", 10, None, False, 4)
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_hot_keys_are_exact_behind_the_buckets(spark):
    from ledgerlens.operators.skew import crowded_keys, hot_keys
    df = spark.createDataFrame([(f"k{i % 40}" if i % 4 else "HOT", i % 3) for i in range(800)], "k string, v int")
    hot, n = hot_keys(df, ["k"], 100)
    assert (n, [r.k for r in hot.collect()]) == (1, ["HOT"])
    assert hot_keys(df, ["k"], 300)[1] == 0
    assert crowded_keys(df, [["k", "v"], ["k"], ["v"]], 100) == {1, 2}


def test_stacked_views_are_dealt_before_they_are_compared(spark):
    cols = ["nom_banco", "num_proposta", "num_contrato", "cliente_id", "val_repasse", "val_comissao", "dat_emprestimo", "status_producao",
            "tipo_operacao", "val_liberado", "dat_credito", "dsc_produto", "prazo", "dsc_convenio", "val_bruto"]
    st = spark.createDataFrame([(*["x"] * 7, s, *["x"] * 7, b) for s, b in [("pago", 1), ("pago", 1), ("PRODUÇÃO", 2), ("PRODUÇÃO", 2), ("y", 1)]],
                               ", ".join(f"{c} string" for c in cols) + ", banco_id long")
    out = RC.stack_platform_views(st.filter("banco_id <> 2"), st.filter("banco_id = 2"))
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.plataforma, r.banco_id) for r in out.collect()) == [("BB", 3), ("NOVA", 1)]


def test_only_rows_of_repeated_ids_are_looked_for_again(spark, monkeypatch):
    held, cut = {}, RC.cut_lineage
    monkeypatch.setattr(RC, "cut_lineage", lambda df, name: held.setdefault(name, cut(df, name)))
    left = spark.createDataFrame([(i if i != 1 else 0, f"x{i}", f"y{i}") for i in range(40)], "src_id long, x string, y string")
    right = spark.createDataFrame([(i, f"x{i * 2}", f"y{i}") for i in range(40)], "id long, x string, y string")
    pairs = RC.staged_pairing(left, right, [("s1", ["x"]), ("s2", ["y"])]).collect()
    assert [r.src_id for r in held["repeated-ids"].collect()] == [0]
    assert held["pending1"].count() == 0  # id 0 was paired with its first row
    assert sorted((p.src_id, p.id) for p in pairs if p.etapa == 1) == [(i, i // 2) for i in range(0, 40, 2)]
    assert {(p.src_id, p.id) for p in pairs if p.etapa == 2} == {(i, i) for i in range(21, 40, 2)}


def test_a_write_back_rates_paired_lines_alone(spark):
    st = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "src_id long, dsc_produto string")
    pairs = spark.createDataFrame([(2, 7), (5, 8)], "src_id long, id long")
    assert sorted(r.src_id for r in RC.paired_statements(st, pairs).collect()) == [2, 5]


def test_a_write_back_leaves_the_keys_of_the_pairing_behind(spark):
    st = spark.createDataFrame([(1, "c", "p", 5, "t")], "src_id long, cliente_id string, numero_proposta string, prazo int, dsc_produto string")
    pairs = spark.createDataFrame([(1, 7)], "src_id long, id long")
    assert sorted(RC.paired_statements(st, pairs).columns) == ["dsc_produto", "prazo", "src_id"]


def test_the_report_derives_its_statements_once(spark):
    from ledgerlens.plans import q_reconcile as QR
    smoke = "/root/testdata/sf0.001"
    assert not [f for f in QR.report_conciliacao(spark, smoke).inputFiles() if "lineitem" in f]
