import datetime as dt
import os

import numpy as np
import pytest
from conftest import rows
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from clickloom.functions import records
from clickloom.operators import batching, encoding, evaluation, runlog
from clickloom.plans import optimizers, training


# --- batches ----------------------------------------------------------------------


def test_shards_of_128_files_over_70_tasks(spark):
    report = batching.shard_report(spark.range(1280), F.col("id") % 128, 70)
    assert rows(report.groupBy("files").count()) == [(1, 12), (2, 58)]
    assert len(batching.part_names("train", 128)) == 128 and batching.part_names("t", 2)[1] == "t/part-00001"


def test_batch_positions_equal_one_global_numbering(spark):
    data = spark.range(1000).withColumn("shard", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 4))
    for bits in (0, 3, 12):
        got = batching.add_batches(data, "id", 7, seed=5, shard="shard", slice_bits=bits).collect()
        by_shard = {}
        for r in got:
            by_shard.setdefault(r.shard, []).append(r)
        for members in by_shard.values():
            members.sort(key=lambda r: (r.shuffle_key, r.id))
            assert [r.position for r in members] == list(range(len(members)))
            assert all(r.batch == r.position // 7 for r in members)


def test_epochs_are_shuffled_differently(spark):
    data = batching.repeat_epochs(spark.range(200), 2)
    got = batching.add_batches(data, "id", 10, seed=5, epoch="epoch").collect()
    orders = [[r.id for r in sorted(got, key=lambda r: r.position) if r.epoch == e] for e in (0, 1)]
    assert sorted(orders[0]) == sorted(orders[1]) == list(range(200)) and orders[0] != orders[1]


def test_shuffle_is_repeatable(spark):
    data = spark.range(500)
    first, second, other = ([r.id for r in batching.shuffle_rows(data.repartition(p), "id", s).collect()]
                            for p, s in ((3, 1), (5, 1), (3, 2)))
    assert first == second != other and sorted(first) == list(range(500))


def test_step_cap(spark):
    data = spark.range(10).withColumnRenamed("id", "batch")
    assert batching.cap_steps(data, 3).count() == 3 and batching.cap_steps(data, None).count() == 10


# --- encoding -----------------------------------------------------------------------


def test_wide_vector_layout():
    spec = encoding.EncoderSpec()
    assert sum(spec.hashed.values()) == 24105 and sum(spec.crossed.values()) == 6256250
    assert spec.width() == 6280355 and len(spec.offsets()) == 33 and len(spec.crossed) == 22


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_wide_positions_fall_in_their_columns(spark, method):
    spec = encoding.EncoderSpec(method=method)
    data = spark.range(300).selectExpr(*[f"id * {i + 3} as {c}" for i, c in enumerate(spec.hashed)])
    ends = [*spec.offsets()[1:], spec.width()]
    for r in encoding.add_wide_positions(data, spec).collect():
        assert all(lo <= p < hi for p, lo, hi in zip(r.wide, spec.offsets(), ends, strict=True))
    both = encoding.add_cross_ids(encoding.add_hash_ids(data, spec), spec)
    assert not [c for c in both.columns if c.startswith("_")]


def test_wide_positions_are_cut_in_small_methods(spark):
    """One method for all ids is too long to be compiled with Spark's default limit."""
    placed = encoding.add_wide_positions(training_rows(spark, 5))
    assert not placed._jdf.queryExecution().executedPlan().toString().startswith("*")
    assert [len(r.wide) for r in placed.collect()] == [33] * 5


def test_crosses_spread_and_depend_on_the_order(spark):
    spec = encoding.EncoderSpec(hashed={}, crossed={("a", "b"): 1000, ("b", "a"): 1000})
    data = spark.range(20000).selectExpr("id % 200 as a", "id div 200 as b")
    got = encoding.add_cross_ids(data, spec)
    counts = [r["count"] for r in got.groupBy("a_x_b").count().collect()]
    assert len(counts) > 990 and max(counts) < 60
    assert got.where("a_x_b <> b_x_a").count() > 19000


# --- run log ----------------------------------------------------------------------------


def ticks(spark, steps, run="r", seconds=lambda s: s * 2.0):
    start = dt.datetime(2024, 1, 1)
    data = [(run, s, start + dt.timedelta(seconds=seconds(s))) for s in steps]
    return spark.createDataFrame(data, "run_id string, global_step bigint, ts timestamp_ntz")


@pytest.mark.parametrize("chunk", [7, 50, 10**6])
def test_throughput_after_warm_up(spark, chunk):
    data = ticks(spark, range(1, 101), seconds=lambda s: s * 2.0 if s <= 50 else 100 + (s - 50) * 4.0)
    got = rows(runlog.examples_per_second(data, 10, every_n_steps=10, warm_steps=20, chunk_steps=chunk))
    by_step = {r[1]: r[2:] for r in got}
    # the first sampled step (21) starts the clock
    assert sorted(by_step) == [31, 41, 51, 61, 71, 81, 91]
    assert by_step[31] == (5.0, 5.0) and by_step[71][0] == 2.5
    assert by_step[91][1] == pytest.approx(10 * 70 / (100 + 41 * 4 - 42))


def test_throughput_by_seconds_and_bad_arguments(spark):
    data = ticks(spark, range(1, 21))
    got = rows(runlog.examples_per_second(data, 8, every_n_secs=10, chunk_steps=4))
    assert sorted(r[1] for r in got) == [5, 10, 15, 20]
    assert all(r[2] == 4.0 for r in got if r[1] > 5)
    for bad in ({}, {"every_n_steps": 1, "every_n_secs": 1}, {"every_n_steps": 0}, {"every_n_secs": 0}):
        with pytest.raises(ValueError):
            runlog.examples_per_second(data, 8, **bad)


def test_sampling_status_and_final_values(spark):
    metrics = ticks(spark, [0, 3, 10, 12, 25]).selectExpr("*", "'loss' as name", "cast(global_step as double) as value")
    assert rows(runlog.sample_metrics(metrics, every_n_steps=10), "global_step") == [(0,), (10,), (25,)]
    assert rows(runlog.sample_metrics(metrics, every_n_secs=20), "global_step") == [(0,), (10,), (25,)]
    assert rows(runlog.final_values(metrics)) == [("r", "loss", 25, 25.0)]
    statuses = ticks(spark, [1, 2]).selectExpr("run_id", "if(global_step = 2, 'success', 'running') as status", "ts")
    assert runlog.latest_status(statuses).first().status == "success"


def test_numeric_metrics(spark):
    data = spark.createDataFrame([("1.5",), ("x",), (None,), ("3",)], "value string")
    assert rows(runlog.numeric_metrics(data)) == [(1.5,), (3.0,)]


def test_stop_decision(spark):
    data = spark.createDataFrame(
        [("a", 1, 0.2), ("a", 2, 0.9), ("a", 3, 0.8), ("a", 4, 0.95), ("b", 1, 0.1)], "run_id string, global_step int, value double")
    assert rows(runlog.stop_steps(data, 0.9)) == [("a", 2), ("b", None)]
    assert rows(runlog.stop_steps(data, None)) == [("a", None), ("b", None)]
    with pytest.raises(ValueError):
        runlog.stop_steps(data, "0.9")
    text = spark.createDataFrame([("high",)], "value string")
    with pytest.raises(Exception, match="must be a number"):
        text.select(runlog.past_stop_threshold(F.col("value"), 1.0)).collect()


def test_metric_and_run_records(spark):
    data = ticks(spark, [1]).selectExpr("*", "'loss' as name", "'0.5' as value", "'x' as unit", "map('b','2','a','1') as extras")
    record = runlog.metric_records(data).first()
    assert [e.name for e in record.extras] == ["a", "b"] and record.timestamp == "2024-01-01T00:00:02.000000Z"
    runs = ticks(spark, [1]).selectExpr("run_id", "'m' as model_name", "'d' as dataset_name", "null as test_id", "ts", "map('n', '3') as params")
    run = runlog.run_records(runs).first()
    assert run.dataset.name == "d" and run.run_parameters[0].long_value == 3 and run.machine_config == {}


# --- evaluation ---------------------------------------------------------------------------


def scored(spark, n=4000):
    return spark.range(n).selectExpr(
        "cast(id % 5 = 0 as int) as label", "(id * 7919 % 1000 + if(id % 5 = 0, 300, 0)) / 1300D as score", "id % 2 as part")


def test_areas_agree_with_spark(spark):
    data = scored(spark)
    got = evaluation.areas(data, bins=2000).first()
    for name, metric in (("auc", "areaUnderROC"), ("auc_precision_recall", "areaUnderPR")):
        exact = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol="label", metricName=metric, numBins=0).evaluate(data)
        assert got[name] == pytest.approx(exact, abs=2e-3)


def test_metrics_by_hand(spark):
    import math

    data = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.1), (0, 0.5)], "label int, score double")
    got = evaluation.evaluate(data, batch_size=2).first()
    loss = -(math.log(0.9) + math.log(0.4) + math.log(0.4) + math.log(0.9) + math.log(0.5))
    assert (got.examples, got.accuracy, got.accuracy_baseline) == (5, 0.6, 0.6)
    assert (got.precision, got.recall, got.label_mean) == (0.5, 0.5, 0.4)
    assert got.average_loss == pytest.approx(loss / 5) and got.loss == pytest.approx(loss / 3)
    grouped = evaluation.evaluate(scored(spark), by=["part"])
    assert rows(grouped, "part", "examples") == [(0, 2000), (1, 2000)]


def test_no_positive_calls(spark):
    data = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    got = evaluation.evaluate(data).first()
    assert (got.precision, got.recall, got.accuracy) == (0.0, 0.0, 1.0)
    assert evaluation.areas(data).first().auc is None


# --- models ---------------------------------------------------------------------------------


def training_rows(spark, n=3000):
    features = ", ".join(f"id * {i * 2 + 3} % {20 + i} as {c}" for i, c in enumerate(encoding.HASH_SIZES))
    return spark.sql(f"select {features}, cast(id % 20 < 6 as int) as label, if(id div 20 % 5 = 0, 0, 1) as r_type from range({n})")


@pytest.mark.parametrize("model_type", [training.WIDE, training.DEEP, training.WIDE_DEEP])
def test_models_train_save_and_score(spark, tmp_path, model_type):
    small = encoding.EncoderSpec(hashed=dict.fromkeys(encoding.HASH_SIZES, 50), crossed=dict.fromkeys(encoding.CROSS_SIZES, 200))
    spec = training.TrainingSpec(encoder=small, partitions=2)
    data = training_rows(spark)
    model, metrics = training.train_and_evaluate(data, model_type, spec)
    row = metrics.first()
    assert row.examples == 600 and row.auc > 0.8
    assert not os.listdir(spark.conf.get("spark.checkpoint.dir")) or not [
        f for f in os.listdir(spark.conf.get("spark.checkpoint.dir")) if f.startswith(("vectors", "encoded", "supports"))]
    path = str(tmp_path / "model")
    training.export_model(model, path)
    before = rows(training.score(model, data, model_type, ["fea9", "fea15"]))
    assert rows(training.score(training.load_model(path), data, model_type, ["fea9", "fea15"])) == before


def test_a_fit_over_classes_of_places_is_that_over_all_places(spark):
    """Same minimum as the plain fit over the whole vector; places that never occur weigh nothing."""
    small = encoding.EncoderSpec(hashed=dict.fromkeys(encoding.HASH_SIZES, 40), crossed=dict.fromkeys(encoding.CROSS_SIZES, 150))
    spec = training.TrainingSpec(encoder=small, reg=0.05, tolerance=1e-12, max_iter=500)
    data = training_rows(spark, 400)
    train = data.where("r_type = 1")
    by_classes = training.fit(train, training.WIDE, spec).stages[-1]
    encode, vectors, learner = training.build_pipeline(training.WIDE, spec).getStages()
    placed = encode.transform(train).select("label", "wide_positions").collect()
    plain = spark.createDataFrame(
        [(float(r.label), Vectors.sparse(small.width(), sorted(r.wide_positions), [1.0] * len(r.wide_positions))) for r in placed], ["label", "wide_features"])
    whole = learner.fit(plain)
    assert len(by_classes.coefficients) == len(whole.coefficients) == small.width()
    assert by_classes.coefficients.toArray() == pytest.approx(whole.coefficients.toArray(), abs=1e-4)
    assert by_classes.intercept == pytest.approx(whole.intercept, abs=1e-3)
    never = whole.coefficients.toArray() == 0
    assert 0 < never.sum() < small.width() and not by_classes.coefficients.toArray()[never].any()


def uneven_rows(spark, n=3000):
    """Features of few and of many values, and a label that both kinds tell of."""
    features = ", ".join(f"xxhash64(id, {i}) % {(3, 40, 2000)[i % 3]} as {c}" for i, c in enumerate(encoding.HASH_SIZES))
    return spark.sql(f"select *, cast(fea9 + fea15 div 13 + id % 7 div 5 > 1 as int) as label from (select id, {features} from range(0, {n}, 1, 3))")


def test_the_wide_fit_gets_to_its_minimum_in_a_few_steps(spark):
    """Rare and frequent places differ in curvature: a fit that is not scaled by it is far off after as many steps."""
    small = encoding.EncoderSpec(hashed=dict.fromkeys(encoding.HASH_SIZES, 50), crossed=dict.fromkeys(encoding.CROSS_SIZES, 3000))
    spec = training.TrainingSpec(encoder=small, max_iter=12)
    train = uneven_rows(spark)
    model = training.fit(train, training.WIDE, spec)
    placed = model.stages[0].transform(train).select("label", "wide_positions").collect()
    weights, y = model.stages[-1].coefficients.toArray(), np.array([r.label for r in placed])
    at = np.array([r.wide_positions for r in placed])
    off = (1 / (1 + np.exp(-weights[at].sum(axis=1) - model.stages[-1].intercept)) - y) / len(y)
    gradient = np.bincount(at.ravel(), np.repeat(off, at.shape[1]), len(weights)) + spec.reg * weights
    # the loss is convex by its penalty, so this bounds how far it is from the least; the first loss is below ln 2
    assert (gradient @ gradient + off.sum() ** 2) / (2 * spec.reg) < spec.tolerance * np.log(2)


def test_sums_of_blocks_are_cut_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(optimizers, "RANGE_PLACES", 7)
    rows = [(float(i % 2), (0, 30, sorted({i % 30, i * i % 30, 29}), [float(i), 1.0, 2.0][:len({i % 30, i * i % 30, 29})])) for i in range(200)]
    rows += [(1.0, (0, 30, [], [])), (0.0, (1, None, None, [0.5] * 30))]
    kind = "label double, v struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    want = np.zeros(30)
    for _, (kind_of, _, places, values) in rows:
        want[places if kind_of == 0 else slice(None)] += values
    blocks = optimizers.packed(spark.createDataFrame(rows, kind).repartition(5), "label", "v")

    def add(block, total):
        y, lengths, occur, at, x = block
        assert len(y) == len(lengths) and lengths.sum() == len(at) == len(x)
        np.add.at(total, occur[at], x)

    assert blocks.getNumPartitions() > 1
    assert optimizers.summed(blocks, add, 30) == pytest.approx(want)
    assert optimizers.label_counts(blocks) == (202, 101, 101)
    blocks.unpersist()


def test_long_sums_take_a_task_for_each_core_and_leave_no_files(spark, monkeypatch):
    """Else each pass writes a vector for each partition, and all passes' files stay until the JVM collects garbage."""
    monkeypatch.setattr(optimizers, "RANGE_PLACES", 100)
    cores, disk = spark.sparkContext.defaultParallelism, spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if os.path.basename(f).startswith("shuffle_")}

    blocks = spark.sparkContext.parallelize(range(5 * cores), 5 * cores).persist()
    tasks, before = spark.sparkContext.accumulator(0), shuffled()

    def once(_, items):
        tasks.add(1)
        yield from items

    def add(block, total):
        total[block::7] += 1

    want = np.zeros(500)
    for k in range(5 * cores):
        add(k, want)
    assert optimizers.summed(blocks, add, 500, before=once).tolist() == want.tolist()
    taken = spark.sparkContext.broadcast(np.arange(3, 500, 4))
    assert optimizers.summed(blocks, add, 500, taken, np.int64).tolist() == want[3::4].tolist()
    assert tasks.value == cores
    assert shuffled() <= before
    blocks.unpersist()


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_the_wide_fit_keeps_hashes_and_makes_the_places_of_them(spark, monkeypatch, method):
    crossed = {("fea15", "fea9"): 4_000_000, ("fea9", "fea30"): 1000}
    small = encoding.EncoderSpec(hashed={"fea9": 500, "fea15": 20000}, crossed=crossed, method=method)
    spec = training.TrainingSpec(encoder=small, max_iter=2)
    data = uneven_rows(spark, 500).selectExpr("*", "if(id % 7 = 0, null, concat('x', id)) as fea30", "id as more")
    staged, plain = {}, training.stage

    def seen(frame, name):
        found = plain(frame, name)
        staged[name] = (found.dtypes, found.collect())
        return found

    monkeypatch.setattr(training, "stage", seen)
    training.fit(data, training.WIDE, spec)
    kinds, found = staged.pop("encoded")
    assert not staged and kinds == [("label", "double"), ("_h_fea9", "int"), ("_h_fea15", "int"), ("_h_fea30", "int")]
    hashes = np.array([r[1:] for r in found], dtype=np.int64).T + (1 << 31)
    places = np.stack(list(small.places()(hashes.astype(np.uint32))), axis=1)
    want = encoding.add_wide_positions(data, small).collect()
    assert sorted(places.tolist()) == sorted(r.wide for r in want) and places.max() > 2_000_000
    frame = training.placed(spark.createDataFrame(found, "label double, _h_fea9 int, _h_fea15 int, _h_fea30 int"), spec, "p")
    assert sorted(r.p for r in frame.collect()) == sorted(places.tolist())


def test_the_deep_fit_is_that_of_sparks_perceptron(spark, monkeypatch):
    """The same steps from the same start, none of them by Spark's products of rows in small blocks."""
    spec = training.TrainingSpec(deep_iter=12, partitions=1)
    train = uneven_rows(spark, 1300)
    theirs = training.build_pipeline(training.DEEP, spec).fit(train.coalesce(1))
    steps, plain = [], training.MultilayerPerceptronClassifier.fit

    def counted(learner, rows, *params):
        steps.append(learner.getMaxIter())
        return plain(learner, rows, *params)

    monkeypatch.setattr(training.MultilayerPerceptronClassifier, "fit", counted)
    ours = training.fit(train, training.DEEP, spec)
    start = training.fit(train, training.DEEP, training.TrainingSpec(deep_iter=0))
    assert steps == [0, 0]
    got, want, begun = (m.stages[-1].weights.toArray() for m in (ours, theirs, start))
    assert got == pytest.approx(want, abs=1e-6) and abs(want - begun).max() > 0.01
    assert ours.stages[-1].getLayers() == theirs.stages[-1].getLayers() == [88, 100, 75, 50, 25, 2, 2]
    loss = training.score(ours, train, training.DEEP, ["label"]).agg(F.avg(F.expr("-ln(if(label = 1, score, 1 - score))"))).first()[0]
    # the loss is that of the model
    vectors = PipelineModel(ours.stages[:-1]).transform(train).select("label", "deep_features").collect()
    stored = spark.createDataFrame([(float(r.label), (0, 88, r.deep_features.toArray().nonzero()[0].tolist(), [1.0] * 11)) for r in vectors],
                                   "label double, v struct<type: tinyint, size: int, indices: array<int>, values: array<double>>")
    blocks = optimizers.packed(stored, "label", "v")
    weights, found = optimizers.fit_perceptron(blocks, [88, *training.HIDDEN_LAYERS, 2], ours.stages[-1].weights.toArray(), 0.0, 0, stack=1)
    blocks.unpersist()
    assert weights.tolist() == ours.stages[-1].weights.toArray().tolist() and found == [pytest.approx(loss, rel=1e-9)]


def test_labels_of_one_kind_are_left_to_sparks_learner(spark):
    small = encoding.EncoderSpec(hashed=dict.fromkeys(encoding.HASH_SIZES, 5), crossed={})
    spec = training.TrainingSpec(encoder=small, deep_iter=2)
    ones = uneven_rows(spark, 60).withColumn("label", F.lit(1))
    wide = training.fit(ones, training.WIDE, spec).stages[-1]
    assert wide.intercept == float("inf") and not wide.coefficients.toArray().any()
    assert training.fit(ones, training.DEEP, spec).stages[-1].numClasses == 2
    with pytest.raises(Exception, match="(?i)label"):
        training.fit(ones.withColumn("label", F.expr("if(id = 3, null, 1)")), training.WIDE, spec)


def test_rows_of_one_task_are_spread_before_a_fit(spark, monkeypatch):
    """A file of one row group would leave every step of the optimizer to one task."""
    files, staged = [], training.stage

    def seen(frame, name):
        found = staged(frame, name)
        files.append((name, len(found.inputFiles())))
        return found

    monkeypatch.setattr(training, "stage", seen)
    hashed = ", ".join(f"xxhash64(id, {i}) as {c}" for i, c in enumerate(encoding.HASH_SIZES))
    data = spark.sql(f"select {hashed}, cast(id % 3 = 0 as int) as label from range(0, 60000, 1, 1)")
    small = encoding.EncoderSpec(hashed=dict.fromkeys(encoding.HASH_SIZES, 5), crossed={})
    model = training.fit(data, training.WIDE, training.TrainingSpec(encoder=small, max_iter=2))
    assert dict(files)["encoded"] > 1
    assert model.stages[-1].getOrDefault("maxBlockSizeInMB") == 32.0


def test_places_of_the_same_rows_are_one_class(spark):
    frame = spark.createDataFrame([(1, [0, 2, 5]), (2, [0, 3, 5]), (3, [0, 3, 9]), (4, []), (5, None)], "id long, p array<long>")
    found = training.place_classes(frame, "p", "id", 10)
    assert found.of_place.tolist() == [0, -1, 1, 2, -1, 3, -1, -1, -1, 4] and found.places.tolist() == [1, 1, 1, 1, 1]
    frame = spark.createDataFrame([(1, [0, 2, 5, 7]), (2, [0, 3, 7]), (3, [9, 8])], "id long, p array<long>")
    found = training.place_classes(frame, "p", "id", 10)
    assert sorted(found.places.tolist()) == [1, 2, 2, 2]
    rows_in = training.in_classes(frame, "p", found).orderBy("id").collect()
    assert [len(r.p.indices) for r in rows_in] == [2, 2, 1] and rows_in[2].p["values"] == [2 ** 0.5]
    assert [r.p.indices == sorted(r.p.indices) for r in rows_in] == [True] * 3
    weights = found.spread(np.arange(1.0, 5.0))
    assert weights[0] == weights[7] and weights[1] == weights[4] == 0 and weights[8] == weights[9]
    with pytest.raises(ValueError, match="outside"):
        training.place_classes(frame, "p", "id", 9)


def test_the_wide_vector_has_a_place_for_every_id(spark):
    spec = training.TrainingSpec()
    rows = training_rows(spark, 50)
    for step in training.build_pipeline(training.WIDE, spec).getStages()[:2]:
        rows = step.transform(rows)
    for r in rows.select("wide_positions", "wide_features").collect():
        assert r.wide_features.size == spec.encoder.width() == 6_280_355
        assert r.wide_features.indices.tolist() == r.wide_positions and set(r.wide_features.values) == {1.0}


def test_the_dense_form_has_eight_values_for_each_feature(spark):
    spec = training.TrainingSpec()
    rows = training_rows(spark, 50)
    encoders = training.build_pipeline(training.DEEP, spec).getStages()[:-1]
    for step in encoders:
        rows = step.transform(rows)
    for r in rows.select("deep_features").collect():
        v = r.deep_features.toArray().reshape(len(encoding.HASH_SIZES), 8)
        assert (v.sum(axis=1) == 1).all()


def test_model_type_is_checked():
    with pytest.raises(ValueError):
        training.build_pipeline("other")


def test_evaluation_of_nothing_and_of_rows_without_score(spark):
    scored = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, None), (None, 0.4)], "label int, score double")
    none = evaluation.evaluate(scored.where("false")).first()
    assert (none.examples, none.unscored, none.accuracy, none.average_loss) == (0, 0, None, None)
    assert evaluation.evaluate_all(scored.where("false")).first().auc is None
    some = evaluation.evaluate(scored).first()
    assert (some.examples, some.unscored, some.accuracy, some.label_mean) == (2, 2, 1.0, 0.5)
    every = evaluation.evaluate_all(scored).first()
    assert (every.examples, every.unscored, every.auc) == (2, 2, 1.0)


def test_latest_status_of_one_time(spark):
    rows = spark.createDataFrame(
        [("a", "success", 5), ("a", "running", 5), ("b", "failure", 7), ("b", "running", 9), ("c", "odd", 1)], "run_id string, status string, s int"
    ).selectExpr("run_id", "status", "timestamp_seconds(s) as ts")
    latest = runlog.latest_status(rows)
    assert {r.run_id: r.status for r in latest.collect()} == {"a": "success", "b": "running", "c": None}
    assert {r.run_id: r.s for r in latest.selectExpr("run_id", "unix_seconds(ts) as s").collect()} == {"a": 5, "b": 9, "c": 1}
    for plan in (latest, runlog.final_values(spark.createDataFrame([("a", "m", 1, 2.0, 3)], "run_id string, name string, global_step long, value double, s int")
                                             .withColumn("ts", F.expr("timestamp_seconds(s)")))):
        assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()


def test_final_values_without_times_or_steps(spark):
    metrics = spark.createDataFrame(
        [("a", "m", 1, 1.0, 5), ("a", "m", 2, 2.0, None), ("b", "m", 7, 3.0, None), ("c", "m", 4, 4.0, None), ("c", "m", 4, 5.0, -62_000_000_000),
         ("d", "m", None, 6.0, 1), ("e", "m", None, 7.0, 9), ("e", "m", -(2 ** 63), 8.0, None), ("f", "m", 3, 9.0, 250_000_000_000), ("f", "m", 4, 10.0, None)],
        "run_id string, name string, global_step long, value double, s long").withColumn("ts", F.expr("timestamp_seconds(s)"))
    assert [r[2:] for r in rows(runlog.final_values(metrics))] == [
        (2, 2.0), (7, 3.0), (4, 5.0), (None, 6.0), (-(2 ** 63), 8.0), (4, 10.0)]


def test_time_texts_are_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        row = spark.range(1).select(
            records.utc_text(F.expr("timestamp_seconds(0)")).alias("zoned"), records.utc_text(F.expr("timestamp_ntz'1970-01-01 00:00:00'")).alias("plain"),
            *[c.alias(n) for n, c in zip(("ds", "hh"), records.hour_of(F.expr("timestamp_seconds(0)"), 1), strict=True)]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.zoned == row.plain == "1970-01-01T00:00:00.000000Z" and (row.ds, row.hh) == ("1969-12-31", "23")
