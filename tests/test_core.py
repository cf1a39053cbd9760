"""Edge cases of the curation and evaluation operators on small literal tables."""

import shutil
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.functions import kernels, paths
from labelloom.operators import audit, evaluate, head, images, runs, split, vocab
from labelloom.plans import scan
from labelloom.plans.select import numbered
from labelloom.sources import ledger, tree

F1 = [0.50, 0.62, 0.64, 0.64, 0.63, 0.62]


def files(spark, rows):
    return spark.createDataFrame([(label, f"{label}/{i}/{name}", name) for i, (label, name) in enumerate(rows)], "label string, path string, name string")


def test_extensions(spark):
    assert paths.extensions("all") is None
    assert paths.extensions("+Foo,+.bar") == {*paths.DEFAULT_EXTENSIONS, ".foo", ".bar"}
    assert paths.extensions("JPG, .png") == {".jpg", ".png"}
    rows = spark.createDataFrame([("a.PNG",), (".png",), ("d.x/noext",), ("b.tar.jpg",), (None,)], "name string")
    assert {r[0] for r in tree.filter_ext(rows).collect()} == {"a.PNG", "b.tar.jpg"}


def test_labels_of_paths(spark):
    rows = spark.createDataFrame([("r/a/x/f.png",), ("r/f.png",), ("other/a/f.png",)], "path string")
    got = rows.select(paths.label_first("path", F.lit("r")), paths.label_parent("path")).collect()
    assert [tuple(r) for r in got] == [("a", "x"), (None, "r"), (None, "a")]


def test_dataset_key(spark):
    rows = spark.createDataFrame([(" a/b ",), ("a",), ("a/b/c",), ("/b",), (None,)], "dataset string")
    got = [tuple(r) for r in rows.select(*paths.split_dataset_key("dataset")).collect()]
    assert got == [("a", "b")] + [("_unknown_", "_unknown_")] * 4


def test_split_is_exact_and_does_not_depend_on_partitions(spark):
    df = files(spark, [("one", "a")] + [("many", str(i)) for i in range(101)])
    want = None
    for n in (1, 4, 64):
        got = {(r.path, r.split) for r in split.stratified_split(df.repartition(n), 0.29).collect()}
        assert want in (None, got)
        want = got
    assert sum(s == "test" for p, s in got if p.startswith("many")) == 29
    assert {s for p, s in got if p.startswith("one")} == {"test"}


def test_val_split_quotas_and_errors(spark):
    df = files(spark, [("a", str(i)) for i in range(7)] + [("b", str(i)) for i in range(4)])
    quotas = {r.label: r.quota for r in split.val_quotas(df, 0.2).collect()}
    assert quotas == {"a": 5, "b": 3}  # 8 for training: 5.09 and 2.91
    with pytest.raises(Exception, match="fewer than two"):
        split.stratified_val_split(files(spark, [("a", "1"), ("b", "1"), ("b", "2")]), 0.5).collect()


def test_unique_names(spark):
    rows = [("train", "c", n, f"{i}/{n}") for i, n in enumerate(["x.png", "x.png", "x__1.png", "x.png", "x__2.png", "x__2.png", ".png", ".png"])]
    df = spark.createDataFrame(rows, "split string, label string, name string, path string")
    got = {r.path: r.dest_name for r in split.assign_unique_names(df).collect()}
    assert len(set(got.values())) == len(rows)
    assert got["0/x.png"] == "x.png" and got["2/x__1.png"] == "x__1.png"
    assert {got["1/x.png"], got["3/x.png"]} == {"x__3.png", "x__4.png"}
    assert got["5/x__2.png"] == "x__2__1.png" and got["7/.png"] == ".png__1"
    taken = df.where("name = 'x.png'").limit(1)
    assert "x.png" not in {r.dest_name for r in split.assign_unique_names(df, taken).collect()}


def test_round_robin_passes_over_small_classes(spark):
    df = files(spark, [("a", "1")] + [("b", str(i)) for i in range(5)])
    assert [(r.label, r.turn) for r in split.round_robin_sample(df, 4).collect()] == [("a", 1), ("b", 1), ("b", 2), ("b", 3)]
    assert split.round_robin_sample(df, 99).count() == 6


def test_positions_and_batches(spark):
    df = files(spark, [("a", str(i)) for i in range(50)])
    assert [r.position for r in numbered(df.repartition(7), "path").orderBy("path").collect()] == list(range(50))
    sizes = [r[1] for r in split.assign_batches(df, 16).groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sizes == [16, 16, 16, 2]


def test_vocabulary(spark):
    long = {str(i): f"c{i}" for i in range(12)}
    df = spark.createDataFrame([(1, long), (2, {v: k for k, v in long.items()})], "k int, entries map<string,string>")
    got = vocab.normalize_vocab(df).orderBy("k", "idx").collect()
    assert [r.label for r in got] == [f"c{i}" for i in range(12)] * 2
    with pytest.raises(Exception, match="indices"):
        vocab.normalize_vocab(spark.createDataFrame([({"a": "b"},)], "entries map<string,string>")).collect()
    bad = spark.createDataFrame([("x", "a"), ("1", ""), ("2", None), ("3", "ok")], "key string, value string")
    assert sorted((r.problem, r.key) for r in vocab.check_vocab(bad).collect()) == [("bad_key", "x"), ("bad_value", "1"), ("bad_value", "2")]
    assert [r.problem for r in vocab.check_vocab(bad.limit(0)).collect()] == ["empty"]
    with pytest.raises(ValueError):
        vocab.require_classes(vocab.build_vocab(spark.createDataFrame([], "label string")))


def test_remap_keeps_indices_of_other_sets(spark):
    a = spark.createDataFrame([(0, "x"), (1, "y")], "idx int, label string")
    b = spark.createDataFrame([(0, "y"), (1, "x")], "idx int, label string")
    c = spark.createDataFrame([(0, "z"), (1, "x")], "idx int, label string")
    p = spark.createDataFrame([(0,), (1,), (5,)], "y_true bigint")
    assert sorted(r.y_true for r in vocab.remap_indices(p, a, b).collect()) == [0, 1, 5]
    assert {(r.y_true, r.remapped) for r in vocab.remap_indices(p.limit(1), a, b).collect()} == {(1, True)}
    assert {(r.y_true, r.remapped) for r in vocab.remap_indices(p.limit(1), a, c).collect()} == {(0, False)}


def test_strict_class_lists(spark):
    a = spark.createDataFrame([(0, "x"), (1, "y")], "idx int, label string")
    assert vocab.verify_classes(a, a, strict=True).first().ok
    with pytest.raises(Exception, match="differ"):
        vocab.verify_classes(a, a.withColumn("idx", 1 - F.col("idx")), strict=True).collect()


def preds(spark, pairs):
    return spark.createDataFrame([(i, t, p, [1.0, 1.0]) for i, (t, p) in enumerate(pairs)], "key bigint, y_true bigint, y_pred bigint, scores array<float>")


def test_metrics_with_a_class_that_is_never_predicted(spark):
    got = {r.label: r for r in evaluate.per_class_metrics(preds(spark, [(0, 0), (1, 0), (1, 0), (2, 0), (None, 1)])).collect()}
    assert set(got) == {0, 1, 2} and got[1].precision == got[1].f1 == 0 and got[0].precision == 0.25 and got[1].support == 2
    cells = {(r.y_true, r.y_pred): r.n for r in evaluate.confusion(preds(spark, [(0, 1), (2, 1)])).collect()}
    assert len(cells) == 9 and cells[1, 1] == 0
    norm = {(r.y_true, r.y_pred): r.share for r in evaluate.confusion_normalized(preds(spark, [(0, 1), (2, 1)])).collect()}
    assert norm[1, 0] == 0 and norm[0, 1] == 1
    assert evaluate.evaluate(preds(spark, [(0, 0), (1, 0)])).first().acc == 0.5


def test_prediction_takes_the_first_of_equal_scores(spark):
    df = spark.createDataFrame([(1, [0.5, 2.0, 2.0]), (2, [1000.0, -1000.0, 0.0]), (3, None)], "key int, scores array<float>")
    got = df.select(evaluate.predict().alias("p"), evaluate.softmax().alias("s")).collect()
    assert [r.p for r in got] == [1, 0, None] and got[1].s[0] == 1.0
    assert evaluate.top_mistakes(preds(spark, [(0, 1)] * 9), 6).count() == 6


def epochs(spark, f1):
    return spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(f1)], "run_id int, epoch bigint, val_f1 double")


def test_run_analytics(spark):
    e = epochs(spark, F1)
    assert tuple(runs.best_epoch(e).first()) == (1, 3, 0.64)
    assert runs.early_stop(e, patience=2).first().stop_epoch == 5
    assert runs.early_stop(e, patience=2, enabled=False).first().stop_epoch is None
    assert runs.early_stop(epochs(spark, [None, None, 0.1]), patience=2).first().stop_epoch == 2
    assert runs.effective_epochs(e, patience=2).count() == 5
    plan = {(r.kind, r.epoch): r.name for r in runs.checkpoint_plan(e, every_n=2).collect()}
    assert sorted(k for k in plan if k[0] != "last") == [("best", 1), ("best", 2), ("best", 3), ("periodic", 2), ("periodic", 4), ("periodic", 6)]
    assert plan["best", 2] == "best_valF1_0.6200_epoch2"
    assert [round(r.lr, 9) for r in runs.lr_history(e, 1e-3, 2, 0.5).orderBy("epoch").collect()] == [1e-3, 1e-3, 5e-4, 5e-4, 2.5e-4, 2.5e-4]


def test_ledger(spark):
    s = spark.createDataFrame([(1, 1, 0, 2.0), (1, 2, 3, 1.0), (1, 3, 0, 9.0), (2, 1, 0, 1.0)], "run_id int, ord int, exit_code int, duration double")
    assert {r.run_id: (r.code, r.n_stages, r.seconds) for r in ledger.run_ledger(s).collect()} == {1: (3, 2, 3.0), 2: (0, 1, 1.0)}
    p = spark.createDataFrame([("o/s", None, 2, ["a"])], "dataset string, path string, num_classes int, classes array<string>")
    assert ledger.validate_pointer(p, "mapping").first().violations == ["missing:path", "missing:written_at_utc", "num_classes"]


def test_letterbox_geometry_cuts_off(spark):
    df = spark.createDataFrame([(55, 30), (71, 10), (83, 83), (224, 224), (1000, 1), (100, 448)], "h bigint, w bigint")
    got = {(r.h, r.w): r for r in images.letterbox_geometry(df, 224).collect()}
    assert [max(got[k].new_h, got[k].new_w) for k in ((55, 30), (71, 10), (83, 83))] == [223, 223, 223]
    assert got[1000, 1].degenerate and got[100, 448].interp == "AREA" and got[224, 224].interp == "LINEAR"
    assert all(r.top + r.new_h + r.bottom == 224 and r.left + r.new_w + r.right == 224 for r in got.values())


def image_table(spark, imgs):
    return spark.createDataFrame([(i, *(x.shape[:2] if x is not None else (-1, -1)), bytearray(x.tobytes()) if x is not None else None) for i, x in enumerate(imgs)], "key int, height int, width int, data binary")


def test_image_jobs(spark):
    rng = np.random.default_rng(0)
    a, flat = rng.integers(0, 256, (10, 20, 3)).astype(np.uint8), np.full((6, 6, 3), 180, np.uint8)
    df = image_table(spark, [a, flat, None, np.zeros((1, 500, 3), np.uint8)])
    got = {r.key: np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, 3) for r in images.letterbox(df, 8).collect()}
    assert set(got) == {0, 1} and not got[0][:2].any() and (got[1] == 180).all()
    assert abs(got[0][2:6].mean() - a.mean()) < 3
    grey = {r.key: r.data for r in images.to_grayscale(df).collect()}
    assert grey[2] is None and set(grey[1]) == {180}
    feats = images.prepare_eval(df).where("key = 1").first().features
    assert len(feats) == 108 and abs(feats[0] - (180 / 255 - 0.485) / 0.229) < 1e-5
    one = {n: sorted(map(str, images.prepare_train(df.repartition(n)).select("key", "features").collect())) for n in (1, 4)}
    assert one[1] == one[4]
    copies = images.augment_copies(df.where("key = 0"), 3, degrees=20).collect()
    assert len(copies) == 4 and [bytes(r.data) == a.tobytes() for r in sorted(copies, key=lambda r: r.copy)][0]
    assert images.stretch_resize(df, 4).where("data is not null").select("height", "width").distinct().count() == 1
    assert images.augment_rotate(df, 0) is df


def test_kernels():
    img = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    assert (kernels.resample(img, 4, 4, True) == img).all() and (kernels.rotate(img, 0) == img).all()
    assert (kernels.rotate(img, 180) == img[::-1, ::-1]).all()
    assert (kernels.jitter(img, 1.0, 1.0, True) == img).all()
    assert kernels.resample(img, 2, 2, True)[0, 0, 0] == round(img[:2, :2, 0].mean() + 1e-9)


def test_audit(spark):
    rows = [
        ("r/a/1.png", "1.png", "a", 2000, True, 3, 8, 8, 0, 0, 0.0, "d1"),
        ("r/a/2.png", "2.png", "a", 10, True, 3, 8, 8, 255, 255, 0.0, "d2"),
        ("r/q/3.png", "3.png", "q", 2000, True, 1, 7, 8, 0, 200, 9.0, "d3"),
        ("r/a/4.png", "4.png", "a", 2000, False, -1, -1, -1, None, None, None, "d3"),
        ("r/a/5.txt", "5.txt", "q", 1, False, None, None, None, None, None, None, "d3"),
        ("r/a/6.png", "6.png", "a", 2000, True, 3, 8, 8, 0, 200, 9.0, "d3"),
    ]
    df = spark.createDataFrame(rows, "path string, name string, label string, bytes bigint, readable boolean, n_channels int, height int, width int, px_min bigint, px_max bigint, px_std double, digest string")
    v = spark.createDataFrame([(0, "a")], "idx int, label string")
    cfg = audit.Config(size=8, strict=True, dup_check=True)
    x = audit.with_rules(df, v, cfg)
    got = {}
    for r in audit.findings(x).collect():
        got.setdefault(r.path[4], []).append(r.code)
    assert got == {"1": ["ALL_BLACK", "LOW_STD"], "2": ["TINY_FILE", "ALL_WHITE", "LOW_STD"], "3": ["BAD_LABEL", "NOT_RGB", "BAD_SIZE", "DUPLICATE"], "4": ["UNREADABLE"], "5": ["BAD_EXT"]}
    assert [r.ok for r in x.orderBy("path").collect()] == [False] * 4 + [True, False]
    s = audit.validation_summary(x, cfg)
    assert tuple(s.first()) == (6, 1, 7, 4, '{"a":3,"q":1}')
    assert [audit.gate(s, f).first().passed for f in ("error", "warning", "never")] == [False, False, True]


def png(path, w, h, rgb):
    raw = b"".join(b"\0" + bytes(rgb) * w for _ in range(h))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_scan_decode_and_write(spark, tmp_path):
    (tmp_path / "in/a/deep").mkdir(parents=True)
    (tmp_path / "in/b").mkdir()
    png(tmp_path / "in/a/x.png", 5, 3, (10, 20, 30))
    (tmp_path / "in/a/deep/y.PNG").write_bytes(b"no image")
    (tmp_path / "in/b/z.txt").write_text("z")
    (tmp_path / "in/top.png").write_bytes(b"x")
    found = tree.scan_class_tree(spark, str(tmp_path / "in"))
    assert sorted((r.label, r.name, r.ext) for r in found.collect()) == [("a", "x.png", ".png"), ("a", "y.PNG", ".png"), ("b", "z.txt", ".txt")]
    assert tree.scan_class_tree(spark, str(tmp_path / "in"), "png").count() == 2
    assert tree.scan_class_tree(spark, str(tmp_path / "none")).count() == 0
    decoded = {r.path.rsplit("/", 1)[1]: r for r in tree.decode_images(spark, str(tmp_path / "in/a")).collect()}
    assert decoded["x.png"].readable and (decoded["x.png"].height, decoded["x.png"].width) == (3, 5) and not decoded["y.PNG"].readable
    assert bytes(decoded["x.png"].data[:3]) == bytes((30, 20, 10))
    out = str(tmp_path / "out")
    rows = found.select("label", "name").withColumn("split", F.lit("train"))
    tree.write_split(rows, out, clear=True)
    tree.write_split(rows, out)
    assert spark.read.parquet(out).count() == 6
    tree.write_split(rows, out, clear=True)
    assert spark.read.parquet(out).count() == 3


def test_softmax_head_learns(spark):
    rng = np.random.default_rng(1)
    y = np.arange(300) % 3
    x = rng.normal(0, 0.3, (300, 4)) + np.eye(3, 4)[y]
    df = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y)], "features array<double>, y_true int")
    w, history = head.fit_softmax_head(df, df, 3, head.HeadConfig(epochs=12))
    assert history[-1]["train_loss"] < history[0]["train_loss"] and max(h["val_acc"] for h in history) > 0.9
    g, loss, n = head._gradient(df.select("features", F.col("y_true").cast("bigint")), w)
    z = np.hstack([x, np.ones((300, 1))]) @ w.T
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert n == 300 and abs(loss + np.log(p[np.arange(300), y]).sum()) < 1e-6
    assert np.allclose(g, (p - np.eye(3)[y]).T @ np.hstack([x, np.ones((300, 1))]))
    assert head.score(df.withColumn("features", F.lit(None).cast("array<double>")), w).where("scores is not null").count() == 0


def test_summaries_are_appended_and_the_latest_is_read(spark, tmp_path):
    from pyspark.sql import functions as F

    from labelloom.sources import ledger

    path = f"{tmp_path}/history"
    for when, f1 in (("2024-01-02", 0.5), ("2024-01-03", 0.7), ("2024-01-01", 0.9)):
        s = spark.createDataFrame([(1, f1), (2, f1 / 2)], "run_id int, best_f1 double")
        ledger.append_summary(s, path, "owner/slug", F.lit(when), F.concat(F.lit("ckpt-"), "run_id"), F.create_map(F.lit("a"), F.lit(0)))
    ledger.append_summary(spark.createDataFrame([(1, 0.1)], "run_id int, best_f1 double"), path, "other/slug", F.lit("2020-01-01"))
    history = spark.read.parquet(path)
    assert history.count() == 7
    got = {(r.dataset, r.run_id): r for r in ledger.latest_summary(history, "run_id").collect()}
    assert {k: r.best_f1 for k, r in got.items()} == {("owner/slug", 1): 0.7, ("owner/slug", 2): 0.35, ("other/slug", 1): 0.1}
    assert got["owner/slug", 1].checkpoint == "ckpt-1" and got["owner/slug", 1].class_to_idx == {"a": 0} and got["other/slug", 1].checkpoint is None


def test_ledger_names_stages_and_sees_gaps(spark):
    from labelloom.sources import ledger

    rows = [("a", i, 0, 1.0) for i in range(1, 7)] + [("b", 1, 0, 1.0), ("b", 3, 0, 1.0)] + [("c", 1, 0, 1.0), ("c", 2, 4, 1.0), ("c", 3, 0, 1.0)] + [("d", i, 0, 1.0) for i in range(1, 8)]
    got = {r.run_id: r for r in ledger.run_ledger(spark.createDataFrame(rows, "run_id string, ord bigint, exit_code bigint, duration double")).collect()}
    assert {k: r.in_order for k, r in got.items()} == {"a": True, "b": False, "c": True, "d": False}
    assert [x.stage for x in got["a"].stages] == list(ledger.STAGES) and got["c"].n_stages == 2 and got["c"].code == 4 and got["d"].stages[-1].stage is None


def test_scores_of_null_features(spark):
    import numpy as np

    from labelloom.operators import head

    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, None), (2, [3.0, 4.0])], "key int, features array<double>")
    got = {r.key: r.scores for r in head.score(df.coalesce(1), np.array([[1.0, 0.0, 0.5], [0.0, 1.0, 0.0], [1.0, 1.0, 1.0]])).collect()}
    assert got == {0: [1.5, 2.0, 4.0], 1: None, 2: [3.5, 4.0, 8.0]}
    assert head.score(df.where("key = 1"), np.ones((2, 3))).first().scores is None and head.score(df.limit(0), np.ones((2, 3))).count() == 0


def test_softmax_head_agrees_with_a_plain_fit(spark, monkeypatch):
    """Gradients added up two at a time give the same weights as one array in memory."""
    monkeypatch.setattr(head, "FAN_IN", 2)
    rng = np.random.default_rng(7)
    y = rng.integers(0, 3, 200)
    x = rng.normal(0, 1, (200, 5)) + 2 * np.eye(3, 5)[y]
    cfg = head.HeadConfig(epochs=6, step=3)
    df = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y)] + [(None, 1), ([0.0] * 5, None)], "features array<double>, y_true int").repartition(9)
    got, history = head.fit_softmax_head(df, df, 3, cfg)
    z, w = np.hstack([x, np.ones((200, 1))]), np.zeros((3, 6))
    m, v, best = np.zeros_like(w), np.zeros_like(w), (-1.0, w)
    for epoch in range(1, cfg.epochs + 1):
        lr = cfg.lr * cfg.gamma ** ((epoch - 1) // cfg.step)
        p = np.exp(z @ w.T) / np.exp(z @ w.T).sum(1, keepdims=True)
        assert abs(history[epoch - 1]["train_loss"] + np.log(p[np.arange(200), y]).mean()) < 1e-9
        g = (p - np.eye(3)[y]).T @ z / 200
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w * (1 - lr * cfg.weight_decay) - lr * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-8)
        f1 = head.macro_f1([(int(a), int(b), 1) for a, b in zip(y, (z @ w.T).argmax(1))])
        best = (f1, w) if f1 > best[0] else best
    assert np.allclose(got, best[1], atol=1e-6)


def test_images_are_written_without_loss(spark, tmp_path):
    rng = np.random.default_rng(2)
    px = {f"i{n}": rng.integers(0, 256, (h, w, 3), dtype=np.uint8) for n, (h, w) in enumerate([(1, 1), (3, 5), (64, 17)])}
    rows = [("a", k, v.shape[0], v.shape[1], v.tobytes()) for k, v in px.items()] + [("b c", "none", None, None, None)]
    df = spark.createDataFrame(rows, "label string, name string, height int, width int, data binary").repartition(3)
    made = {r.name: r for r in tree.write_images(df, str(tmp_path / "out")).collect()}
    assert set(made) == {*px, "none"} and made["none"].bytes == len(tree.SIGNATURE)
    read = {r.path.rsplit("/", 1)[1].removesuffix(".png"): r for r in tree.decode_images(spark, str(tmp_path / "out")).collect()}
    assert {k for k, r in read.items() if r.readable} == set(px) and len(read) == 4
    for k, v in px.items():
        assert (read[k].height, read[k].width) == v.shape[:2] and bytes(read[k].data) == v.tobytes()


def test_unique_names_with_hot_names_and_many_taken_numbers(spark, monkeypatch):
    """Against a plain count, with blocks so small that one name has many of them."""
    monkeypatch.setattr(scan, "BLOCK", 4)
    names = ["x.png"] * 60 + [f"x__{i}.png" for i in (1, 2, 3, 5, 8, 9, 40, 41, 99)] + ["x__5.png", "x__05.png", "y", "y", "y__1", ".z", ".z"]
    rows = [("train", "c", n, f"{i:03}") for i, n in enumerate(names)] + [("test", "c", "x.png", "a"), ("test", "c", "x.png", "b")]
    taken = [("train", "c", f"x__{i}.png") for i in range(10, 20)] + [("test", "c", "x.png"), ("train", "d", "q")]
    df, held = spark.createDataFrame(rows, "split string, label string, name string, path string"), spark.createDataFrame(taken, "split string, label string, name string")
    want = {}
    blocked = {r[:3] for r in rows} | set(taken)
    seen = {}
    for s, c, n, path in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        k = seen.get((s, n), 0)
        if k == 0 and (s, c, n) not in taken and (s, n, "kept") not in seen:
            seen[s, n, "kept"] = 1
            want[path] = n
            continue
        stem, ext = (n.rpartition(".")[0], "." + n.rpartition(".")[2]) if "." in n[1:] else (n, "")
        k += 1
        while (s, c, f"{stem}__{k}{ext}") in blocked:
            k += 1
        seen[s, n] = k
        want[path] = f"{stem}__{k}{ext}"
    assert {r.path: r.dest_name for r in split.assign_unique_names(df, held).collect()} == want


def test_copies_of_a_hot_digest_are_found(spark):
    rows = [(f"p{i:04}", "hot" if i % 3 == 0 else None if i % 3 == 1 else f"d{i // 4}") for i in range(600)]
    df = spark.createDataFrame(rows, "path string, digest string")
    first = {}
    for p, g in rows:
        first.setdefault(g, p)
    got = {r.path: r.first_path for r in audit.first_copies(df).collect()}
    assert got == {p: first[g] if g is not None and first[g] != p else None for p, g in rows}


def test_audit_of_a_folder(spark, tmp_path):
    root = tmp_path / "in"
    for label in ("a", "a/deep", "zz"):
        (root / label).mkdir(parents=True, exist_ok=True)
    rng = np.random.default_rng(3)
    noise = lambda h, w: rng.integers(0, 256, (h, w, 3), dtype=np.uint8)
    good, flat = noise(8, 8), np.full((8, 8, 3), 180, np.uint8)
    save = lambda at, img: (root / at).write_bytes(tree.png(*img.shape[:2], img.tobytes()))
    for at, img in (("a/1.png", good), ("a/2.png", good), ("a/3.PNG", noise(8, 9)), ("a/deep/4.png", noise(8, 8)), ("zz/5.png", flat), ("a/6.png", flat * 0), ("a/7.png", good * 0 + 255)):
        save(at, img)
    (root / "a/8.png").write_bytes((root / "a/1.png").read_bytes()[:60])
    (root / "a/9.txt").write_bytes(b"text")
    vocab_ = spark.createDataFrame([(0, "a")], "idx int, label string")
    got = {(r.path, r.code, r.detail) for r in audit.findings(audit.audit_tree(spark, str(root), vocab_, audit.Config(size=8, min_file_bytes=65, dup_check=True))).collect()}
    assert got == {
        ("a/2.png", "DUPLICATE", "a/1.png"), ("a/3.PNG", "BAD_SIZE", "9x8"), ("a/deep/4.png", "BAD_LABEL", "deep"), ("zz/5.png", "BAD_LABEL", "zz"), ("zz/5.png", "LOW_STD", ""),
        ("a/6.png", "ALL_BLACK", ""), ("a/6.png", "LOW_STD", ""), ("a/7.png", "ALL_WHITE", ""), ("a/7.png", "LOW_STD", ""), ("a/8.png", "UNREADABLE", ""), ("a/8.png", "TINY_FILE", "60"), ("a/9.txt", "BAD_EXT", "9.txt"),
    }
    (tmp_path / "none").mkdir()
    assert audit.audit_tree(spark, str(tmp_path / "none"), vocab_, audit.Config()).count() == 0


def test_a_folder_of_many_small_files_is_read_in_few_tasks(spark, tmp_path):
    root = tmp_path / "in"
    for label in ("a", "b"):
        (root / label).mkdir(parents=True)
    body = tree.png(2, 2, bytes(range(12)))
    for i in range(1200):
        (root / "ab"[i % 2] / f"{i}.png").write_bytes(body if i % 10 else body[:20])
    decoded = tree.decode_images(spark, str(root))
    assert decoded.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism  # Spark alone makes a task of 32 files
    assert decoded.where("readable and length(data) = 12").count() == 1080 and decoded.count() == 1200
    scanned = tree.scan_class_tree(spark, str(root), "png")
    assert scanned.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism and scanned.where("length(content) = length").count() == 1200


def test_an_audit_does_not_read_files_again(spark, tmp_path):
    root = tmp_path / "in"
    (root / "a").mkdir(parents=True)
    for i in range(3):
        (root / f"a/{i}.png").write_bytes(tree.png(2, 2, bytes(range(i // 2, 12 + i // 2))))
    audited = audit.audit_tree(spark, str(root), spark.createDataFrame([(0, "a")], "idx int, label string"), audit.Config(size=2, min_file_bytes=1, dup_check=True))
    shutil.rmtree(root)
    assert [(r.path, r.code, r.detail) for r in audit.findings(audited).where("code = 'DUPLICATE'").collect()] == [("a/1.png", "DUPLICATE", "a/0.png")]
