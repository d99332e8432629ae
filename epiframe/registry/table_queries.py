"""Queries on training logs, images, state vectors, identifiers, snapshots and streams."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiframe.functions import ids, images, state
from epiframe.functions import metrics as text
from epiframe.operators import tables
from epiframe.operators.control import interval_micros
from epiframe.operators.ordered import dense_index
from epiframe.operators.sampling import restore_order
from epiframe.operators.windows import sliding_windows
from epiframe.plans.cached import cache_frames
from epiframe.plans.convert import convert_to_windows, resize_frames
from epiframe.plans.quality_filter import filter_dataset
from epiframe.plans.record import record_dataset as store_recording
from epiframe.registry import views
from epiframe.registry.episode_queries import stuck_frames
from epiframe.schema import EPISODE, STATE
from epiframe.sources import frames as frame_store
from epiframe.sources import logs, snapshot
from epiframe.sources.indexed import read_indexed, write_indexed
from epiframe.sources.windows import read_windows as read_stored_windows
from epiframe.storage import pin, scratch_dir
from epiframe.streaming.metrics import stream_metrics as parse_lines
from epiframe.streaming.rate import stream_rate
from epiframe.streaming.record import stream_frames
from epiframe.streaming.runs import read_runs, run_report, stream_runs, update_runs
from epiframe.streaming.sinks import drain, stream_ingest, stream_parquet
from epiframe.streaming.stuck import stream_stuck_actions as detect_stuck

# -- training metrics ------------------------------------------------------------


def format_metric(spark: SparkSession, sf: str):
    events = views.table(spark, sf, "events")
    line = text.format_metric(F.col("event_type"), F.col("value") * 1000 / 7, F.col("event_id"), prefix="eval")
    return events.select("event_id", line.alias("line"))


def format_metric_unstepped(spark, sf):
    orders = views.table(spark, sf, "orders")
    return orders.select("o_orderkey", text.format_metric(F.lit("total_price"), F.col("o_totalprice")).alias("line"))


def metric_names(spark, sf):
    part = views.table(spark, sf, "part")
    candidates = F.explode(F.array("p_name", "p_brand", "p_type", F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("___"), F.lit("")))
    return part.select("p_partkey", candidates.alias("name")).select("p_partkey", "name", text.is_metric_name(F.col("name")).alias("valid"))


def _document_lines(spark, sf):
    lines = F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    return views.table(spark, sf, "documents").select("doc_id", lines)


def parse_metric(spark, sf):
    found = views.log_lines(spark, sf).select("run_id", "line_no", text.parse_metric(F.col("line")).alias("m"))
    return found.select("run_id", "line_no", "m.name", "m.value")


def parse_metric_prose(spark, sf):
    """Lines of prose: the first match is often junk and then dropped."""
    found = _document_lines(spark, sf).select("doc_id", F.col("line_no").cast("long"), text.parse_metric(F.col("line")).alias("m"))
    return found.where("m IS NOT NULL").select("doc_id", "line_no", "m.name", "m.value")


def parse_arch_metric(spark, sf):
    found = text.parse_arch_metric(F.col("line"), F.col("target_arch"))
    return views.arch_lines(spark, sf).select("run_id", "line_no", found.alias("m")).select("run_id", "line_no", "m.name", "m.value")


def parse_step(spark, sf):
    return views.log_lines(spark, sf).select("run_id", "line_no", text.parse_step(F.col("line")).alias("step"))


def thin_log(spark, sf):
    metrics = views.log_lines(spark, sf).select("run_id", text.parse_step(F.col("line")).alias("step"))
    return tables.thin_log(metrics, every=50)


def attach_primary_metric(spark, sf):
    return tables.attach_primary_metric(views.runs(spark, sf))


def _primary(spark, sf):
    found = text.parse_arch_metric(F.col("line"), F.col("target_arch"))
    return views.arch_lines(spark, sf).select("run_id", "line_no", found.alias("m")).where("m IS NOT NULL").select("run_id", "line_no", "m.name", "m.value")


def last_metric(spark, sf):
    return tables.last_metric(views.runs(spark, sf), _primary(spark, sf))


def best_metric(spark, sf):
    runs = tables.attach_primary_metric(views.runs(spark, sf))
    return tables.best_metric(runs, _primary(spark, sf)).select("run_id", "metric", "best")


def distinct_metrics(spark, sf):
    found = views.log_lines(spark, sf).select("run_id", text.parse_step(F.col("line")).alias("step"), text.parse_metric(F.col("line"))["name"].alias("name"), text.parse_metric(F.col("line"))["value"].alias("value"))
    return tables.distinct_metrics(found.unionByName(found))


# -- training logs as files and streams ----------------------------------------------


def _write_log(spark, sf, path):
    """The events as metric lines; returns the folder."""
    events = views.table(spark, sf, "events").repartitionByRange("event_id").sortWithinPartitions("event_id")
    logs.write_metric_lines(events, path, F.col("event_type"), F.col("value"), F.col("event_id"))
    return path


def write_metric_lines(spark, sf):
    return spark.read.text(_write_log(spark, sf, scratch_dir(spark))).withColumnRenamed("value", "line")


def read_train_log(spark, sf):
    """Line numbers follow the file; steps rise with them, so each file is in order."""
    lines = logs.read_train_log(spark, _write_log(spark, sf, scratch_dir(spark)))
    step = text.parse_step(F.col("line"))
    per_file = lines.groupBy("file").agg(F.min(step).alias("_first"))
    return lines.join(per_file, "file").select(step.alias("step"), (step - F.col("_first") + 1 == F.col("line_no")).alias("in_order"))


def stream_metrics(spark, sf):
    base = scratch_dir(spark)
    lines = logs.stream_train_log(spark, _write_log(spark, sf, f"{base}/log"))
    return drain(parse_lines(lines), f"{base}/out", f"{base}/checkpoint").select("name", "value", "step")


def stream_run_table(spark, sf):
    """Log lines arrive in three parts, the query starts anew for each, and the last batch is delivered once more."""
    base = scratch_dir(spark)
    lines = views.arch_lines(spark, sf)
    last = lines.agg(F.max("line_no")).first()[0] or 0
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in lines.schema.fields])
    for part in range(3):
        now = lines.where((F.col("line_no") * 3 >= part * (last + 1)) & (F.col("line_no") * 3 < (part + 1) * (last + 1)))
        now.write.mode("append").parquet(f"{base}/in")
        found = parse_lines(stream_parquet(spark, f"{base}/in", schema), F.col("target_arch"))
        stream_runs(found, f"{base}/runs", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    update_runs(parse_lines(now, F.col("target_arch")), 2, f"{base}/runs")
    return run_report(views.runs(spark, sf), read_runs(spark, f"{base}/runs"))


# -- frames as files and streams ----------------------------------------------------


def _stored_frames(spark, sf, path):
    narrow = views.frames(spark, sf).select("episode_index", "frame_index", "event_id", "action", "state")
    frame_store.write_frames(narrow, path)
    return path


def write_read_frames(spark, sf):
    stored = frame_store.read_frames(spark, _stored_frames(spark, sf, scratch_dir(spark)), schema=None)
    return stored.select("episode_index", "frame_index", "event_id", F.round(F.col("action")[0], 6).alias("a0"))


def dataset_meta(spark, sf):
    from epiframe.operators.episodes import add_timestamp

    base = scratch_dir(spark)
    narrow = add_timestamp(views.frames(spark, sf)).select("episode_index", "frame_index", "timestamp", "action")
    frame_store.write_dataset_meta(narrow, base, {"action": 2}, 30)
    largest = spark.read.parquet(f"{base}/stats").agg(F.round(F.max("max"), 4)).scalar()
    return spark.read.parquet(f"{base}/info").withColumn("largest_action", largest)


def _facts(windows):
    ids_ = F.transform("steps", lambda s: s["event_id"])
    return windows.select(
        "episode_index", "start", F.size("steps").cast("long").alias("n_steps"),
        F.element_at(ids_, 1).alias("first_event"), F.element_at(ids_, -1).alias("last_event"),
        F.round(F.aggregate("steps", F.lit(0.0), lambda acc, s: acc + s["action"][0]), 4).alias("sum_value"),
    )


def read_windows(spark, sf):
    """Windows as they were stored."""
    base = scratch_dir(spark)
    windows = sliding_windows(views.frames(spark, sf), columns=("action", "event_id"))
    windows.write.parquet(f"{base}/windows")
    return _facts(read_stored_windows(spark, base))


def read_windows_from_frames(spark, sf):
    """No windows stored: one head window per episode."""
    return _facts(read_stored_windows(spark, _stored_frames(spark, sf, scratch_dir(spark)), ("action", "event_id")))


def stream_ingest_frames(spark, sf):
    base = scratch_dir(spark)
    schema = views.table(spark, sf, "events").schema
    stream_ingest(spark, sf, f"{base}/frames", f"{base}/checkpoint", schema, "events.parquet").awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/frames").select("event_id", "user_id", "event_type", "value")


def stream_stuck_actions(spark, sf):
    base = scratch_dir(spark)
    stored = stuck_frames(spark, sf).select("episode_index", "frame_index", "action")
    frame_store.write_frames(stored, base)
    live = stream_parquet(spark, f"{base}/frames", stored.schema)
    hits = drain(detect_stuck(live, warn_steps=2), f"{base}/out", f"{base}/checkpoint")
    return hits.select("episode_index", "frame_index", "repeat_count", F.col("action")[0].alias("a0"), F.col("action")[1].alias("a1"))


def stream_rate_audit(spark, sf):
    """Frames arrive in three parts by their time, the query starting anew for each: late frames, counted by episode."""
    base = scratch_dir(spark)
    micros = interval_micros(F.col("ts"), F.expr("TIMESTAMP_NTZ'1970-01-01'"))
    frames = pin(views.frames(spark, sf).select("episode_index", "frame_index", micros.alias("us")))
    low, high = frames.agg(F.coalesce(F.min("us"), F.lit(0)), F.coalesce(F.max("us"), F.lit(0))).first()
    timed = frames.select("episode_index", "frame_index", F.timestamp_micros("us").alias("ts"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in timed.schema.fields])
    part_of = F.floor((F.col("us") - low) * 3 / (high - low + 1))
    for part in range(3):
        now = frames.where(part_of == part).select("episode_index", "frame_index", F.timestamp_micros("us").alias("ts"))
        now.write.mode("append").parquet(f"{base}/in")
        found = drain(stream_rate(stream_parquet(spark, f"{base}/in", schema)), f"{base}/out", f"{base}/checkpoint")
    return found.where("kind = 'late'").groupBy("episode_index").agg(F.count("*").alias("n_overruns"), F.max("gap_us").alias("max_gap_us"))


def stream_recording(spark, sf):
    """Step logs that arrive in three parts, the query starting anew for each: frames of the episodes that close."""
    base = scratch_dir(spark)
    steps = views.steps(spark, sf)
    last = steps.agg(F.max("seq")).first()[0] or 0
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in steps.schema.fields])
    for part in range(3):
        now = steps.where((F.col("seq") * 3 >= part * (last + 1)) & (F.col("seq") * 3 < (part + 1) * (last + 1)))
        now.write.mode("append").parquet(f"{base}/in")
        found = drain(stream_frames(stream_parquet(spark, f"{base}/in", schema), max_steps=None), f"{base}/out", f"{base}/checkpoint")
    return found.select(
        "stream_id", "seq", "episode_index", "frame_index", F.round(F.col("timestamp").cast("double"), 5).alias("timestamp"),
        F.round(F.col(f"`{STATE}`")[0].cast("double"), 3).alias("s0"), F.col("action")[0].cast("double").alias("a0"),
    )


# -- images -----------------------------------------------------------------------


def _bytes(spark, sf):
    return views.images(spark, sf).withColumn("image", images.quantize_u8("image"))


def image_stats(spark, sf):
    """Vectors as byte images with two channels."""
    out = images.image_stats(views.table(spark, sf, "embeddings").select(views.pixels(spark, sf).alias("image")), ["image"], {"image": 2})
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


def filtered_dataset_meta(spark, sf):
    """Episodes of a dataset that was filtered, from its side table."""
    path = scratch_dir(spark)
    stored = views.frames(spark, sf).select("episode_index", "frame_index", (F.col("frame_index") / 30).cast("float").alias("timestamp"), "action", "state")
    frame_store.write_frames(stored, path)
    frame_store.write_dataset_meta(stored, path, {"action": 2, "state": 2}, 30)
    filter_dataset(spark, path, 2, min_episode_length=60, ted_threshold=1e9, sal_threshold=0.0)
    facts = spark.read.parquet(f"{path}_filtered/episodes").select("episode_index", "length")
    info = spark.read.parquet(f"{path}_filtered/info").first()
    n_stats = spark.read.parquet(f"{path}_filtered/stats").count()
    return facts.withColumns({c: F.lit(info[c]).cast("long") for c in ("total_episodes", "total_frames")}).withColumn("n_stats", F.lit(n_stats).cast("long"))


def quantize_u8(spark, sf):
    return _bytes(spark, sf).select("row_index", F.hex("image").alias("pixels"))


def quantize_array(spark, sf):
    q = views.images(spark, sf).select("row_index", F.posexplode(images.quantize_array(F.col("image"))).alias("pos", "q"))
    return q.select("row_index", F.col("pos").cast("long").alias("pos"), F.col("q").cast("long").alias("q"))


def dequantize_u8(spark, sf):
    back = _bytes(spark, sf).select("row_index", F.posexplode(images.dequantize_u8("image")).alias("pos", "x"))
    return back.select("row_index", F.col("pos").cast("long").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("x"))


def hwc_to_chw(spark, sf):
    moved = images.hwc_to_chw(F.col("image"), 8, 8, 3)
    out = views.images(spark, sf).select("row_index", F.posexplode(moved).alias("pos", "x"))
    return out.select("row_index", F.col("pos").cast("long").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("x"))


def hwc_to_chw_bytes(spark, sf):
    return _bytes(spark, sf).select("row_index", F.hex(images.hwc_to_chw_bytes(F.col("image"), 8, 8, 3)).alias("pixels"))


def resize_images(spark, sf):
    small = resize_frames(_bytes(spark, sf), {"image": (8, 8, 3)}, (4, 4))
    return small.select("row_index", F.hex("image").alias("pixels"))


def coerce_image(spark, sf):
    """Shapes by label: channel-last, channel-first, batched, wrong and missing."""
    kind = F.pmod(F.col("label"), F.lit(5))
    shape = F.when(kind == 0, F.lit([8, 8, 3])).when(kind == 1, F.lit([3, 8, 8])).when(kind == 2, F.lit([1, 8, 8, 3])).when(kind == 3, F.lit([8, 3, 8]))
    out = images.coerce_image(F.col("image"), shape, 8)
    return _bytes(spark, sf).select("row_index", F.hex(out).alias("pixels"))


def row_bytes(spark, sf):
    both = views.images(spark, sf).withColumn("packed", images.quantize_u8("image"))
    return both.select("row_index", images.row_bytes(both).alias("n_bytes"))


def image_columns(spark, sf):
    """Only the wide column is an image: the other has too few values."""
    tiled = views.images(spark, sf).withColumn("front_rgb", F.flatten(F.array_repeat("image", 16)))
    return images.image_report(tiled)


def normalized_columns(spark, sf):
    scaled = views.images(spark, sf).withColumn("bright", F.transform("image", lambda x: x * F.lit(255.0).cast("float")))
    both = images.normalized_report(scaled, "image").withColumn("column_name", F.lit("image")).unionByName(
        images.normalized_report(scaled, "bright").withColumn("column_name", F.lit("bright"))
    )
    return both.withColumn("max_value", F.round("max_value", 4))


def size_budget(spark, sf):
    """A ceiling of 64 kB, crossed in the middle of the table."""
    return tables.size_budget(views.images(spark, sf).select("row_index", "image"), max_gb=6.4e-5, chunk=64)


# -- state and action vectors --------------------------------------------------------


def _flat(spark, sf):
    """Flat observations of 0, 5, 6, 18 or 25 values, by label."""
    sizes = F.element_at(F.lit([0, 5, 6, 18, 25]), (F.pmod(F.col("label"), F.lit(5)) + 1).cast("int"))
    return views.table(spark, sf, "embeddings").select("vec_id", F.slice("embedding", F.lit(1), sizes).alias("flat"))


def _values(df, column, *keys):
    out = df.select(*keys, F.posexplode(column).alias("pos", "x"))
    return out.select(*keys, F.col("pos").cast("long").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("x"))


def split_state(spark, sf):
    return _values(_flat(spark, sf), state.split_state(F.col("flat")), "vec_id")


def split_state_with_pose(spark, sf):
    return _values(_flat(spark, sf), state.split_state(F.col("flat"), include_object_pose=True), "vec_id")


def assemble_state_terms(spark, sf):
    flat = views.table(spark, sf, "embeddings")
    joints = F.when(F.col("label") != 0, F.slice("embedding", 1, 12))
    pose = F.when(F.col("label") != 1, F.slice("embedding", 19, 9))
    return _values(flat, state.assemble_state_terms(joints, pose), "vec_id")


def object_pose(spark, sf):
    pose = state.object_pose(F.col("embedding"))
    both = views.table(spark, sf, "embeddings").select("vec_id", pose.alias("p"))
    return _values(both, F.concat(F.col("p.quat"), F.col("p.pos")), "vec_id")


def motors_to_state(spark, sf):
    """Motors named so that name order and table order differ."""
    motors = views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("wrist.pos"), F.col("l_extendedprice").alias("elbow.pos"), F.col("l_discount").alias("gripper.pos")
    )
    out = state.motors_to_state(motors, "s")
    return out.select("l_orderkey", "l_linenumber", *[F.round(F.col("s")[i].cast("double"), 2).alias(f"s{i}") for i in range(3)])


def action_to_columns(spark, sf):
    named = state.action_to_columns(views.frames(spark, sf).select("episode_index", "frame_index", "action"), ["wrist", "elbow"])
    return named.select("episode_index", "frame_index", F.col("`wrist.pos`").alias("wrist"), F.col("`elbow.pos`").alias("elbow"))


def rename_image_columns(spark, sf):
    cameras = _bytes(spark, sf).select("row_index", F.hex("image").alias("wrist"), F.col("label").cast("double").alias("elbow.pos"))
    out = state.rename_image_columns(cameras, keep=["row_index"])
    return out.withColumnRenamed("elbow.pos", "elbow_pos").withColumnRenamed("observation.images.wrist", "observation_images_wrist")


# -- identifiers, selection, merging, snapshots ------------------------------------------


def signature(spark, sf):
    docs = views.table(spark, sf, "documents")
    per_source = docs.groupBy("source").agg(F.count("*").alias("n_rows"), F.collect_set("lang").alias("keys"))
    key = ids.signature(F.concat(F.lit("local/"), "source"), F.lit("/data"), F.col("n_rows"), F.col("keys"), F.lit("1"))
    return per_source.select("source", key.alias("signature"))


def dataset_id(spark, sf):
    pages = views.table(spark, sf, "pages")
    return pages.select("page_id", ids.dataset_id(F.col("url"), F.col("url").startswith("https")).alias("dataset_id"))


def recording_id(spark, sf):
    part = views.table(spark, sf, "part")
    return part.select("p_partkey", ids.recording_id(F.concat_ws("-", "p_type", "p_brand")).alias("recording_id"))


def select_rows(spark, sf):
    """The labelled documents in label order, each listed twice."""
    labels = views.table(spark, sf, "labels").select("doc_id")
    placed = dense_index(labels, ["doc_id"], "_i")
    listed = placed.select(F.col("doc_id").alias("row_index"), F.explode(F.array(F.col("_i") * 2, F.col("_i") * 2 + 1)).alias("pos"))
    docs = views.table(spark, sf, "documents").withColumnRenamed("doc_id", "row_index")
    return tables.select_rows(docs, listed).select("pos", "row_index", "n_chars")


def select_indexed(spark, sf):
    """Documents stored by index; the labelled ones in label order, each listed twice, from the files that hold them."""
    base = scratch_dir(spark)
    docs = views.table(spark, sf, "documents").withColumnRenamed("doc_id", "row_index")
    write_indexed(docs, base, part_bytes=1 << 18)
    placed = dense_index(views.table(spark, sf, "labels").select("doc_id"), ["doc_id"], "_i")
    listed = placed.select(F.col("doc_id").alias("row_index"), F.explode(F.array(F.col("_i") * 2, F.col("_i") * 2 + 1)).alias("pos"))
    return read_indexed(spark, base, listed).select("pos", "row_index", "n_chars")


def restored_order(spark, sf):
    """Rows scattered by a hash come back in order."""
    docs = views.table(spark, sf, "documents").withColumnRenamed("doc_id", "row_index")
    back = restore_order(docs.repartition("source", "lang"))
    return back.select("row_index", "n_chars")


def merge_sources(spark, sf):
    narrow = views.frames(spark, sf).select("episode_index", "frame_index", "value")
    merged = tables.merge_sources({"real": narrow, tables.RECORDED_SOURCE: narrow.withColumn("value", F.col("value") * 2)})
    return merged.withColumn("value", F.round("value", 4))


def renumber_episodes(spark, sf):
    """Events and conversations, merged as two sources of episodes."""
    real = views.frames(spark, sf).select("episode_index", "frame_index")
    turns = views.table(spark, sf, "conversations").select(F.col("conv_id").alias("episode_index"), F.col("turn").alias("frame_index"))
    return tables.renumber_episodes(tables.merge_sources({"real": real, tables.RECORDED_SOURCE: turns}))


def record_dataset(spark, sf):
    """The step logs of all users, stored as one dataset."""
    stored = store_recording(views.steps(spark, sf), scratch_dir(spark), {STATE: 1, "action": 1})
    return stored.select(
        "episode_index", "frame_index", F.round(F.col("timestamp").cast("double"), 5).alias("timestamp"),
        F.round(F.col(f"`{STATE}`")[0].cast("double"), 3).alias("s0"), F.col("action")[0].cast("double").alias("a0"),
    )


def shape_report(spark, sf):
    """Vectors that should hold 64 values, and some that do not."""
    declared = {"metadata": {"shape": [64]}}
    data = views.table(spark, sf, "embeddings").select(
        F.col("embedding").alias("whole", **declared),
        F.when(F.col("label") == 3, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")).alias("cut", **declared),
    )
    return frame_store.shape_report(data)


def snapshot_by_file(spark, sf):
    """Events that arrive in three files: the third is added to a snapshot of the first two."""
    base = scratch_dir(spark)
    events = views.table(spark, sf, "events").select("event_id", "user_id", "value")

    def doubled(df):
        return df.withColumn("value", F.round(F.col("value") * 2, 4))

    def add(part):
        events.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{base}/in")

    add(0)
    add(1)
    snapshot.materialize_files(spark, f"{base}/in", doubled, base, "events")
    add(2)
    return snapshot.materialize_files(spark, f"{base}/in", doubled, base, "events")


def snapshot_windows(spark, sf):
    """Windows stored under a signature of their input, then read back from it."""
    base = scratch_dir(spark)
    inputs = snapshot.input_fingerprint(spark, f"{sf}/events.parquet")
    n_rows = views.table(spark, sf, "events").count()
    key = snapshot.snapshot_signature(spark, "local/events", base, n_rows, [], inputs)
    windows = sliding_windows(views.frames(spark, sf), columns=("action", "event_id"))
    snapshot.materialize(windows, base, key)
    return _facts(snapshot.materialize(windows, base, key))


def persisted_frames(spark, sf):
    kept = frame_store.persist_frames(views.frames(spark, sf).select(*EPISODE, "frame_index", "value"))
    try:
        return pin(_totals(kept))
    finally:
        kept.unpersist()


def _totals(kept):
    return kept.groupBy(*EPISODE).agg(F.max("frame_index").alias("last_frame"), F.round(F.sum("value"), 3).alias("sum_value"))


def converted_windows(spark, sf):
    """Normalised actions in stored windows; the second conversion finds the first."""
    base = scratch_dir(spark)
    source = views.frames(spark, sf).select("episode_index", "frame_index", "action")
    convert_to_windows(source, base, 2)
    out = convert_to_windows(source, base, 2).select("episode_index", "start", F.posexplode("steps").alias("t", "s"))
    return out.select("episode_index", "start", F.col("t").cast("long").alias("t"), F.round(F.col("s.action")[0].cast("double"), 5).alias("a0"))


def cached_frames(spark, sf):
    """Normalised images packed, stored once and read back through the manifest; other columns untouched."""
    base = scratch_dir(spark)
    rows = views.images(spark, sf).select("row_index", "label", F.flatten(F.array_repeat("image", 8)).alias("front_rgb"))
    cache_frames(rows, base, "local/embeddings", base, f"{sf}/embeddings.parquet")
    back = cache_frames(rows, base, "local/embeddings", base, f"{sf}/embeddings.parquet").frames()
    total = F.aggregate("front_rgb", F.lit(0.0), lambda acc, x: acc + F.round(x.cast("double") * 255))
    return back.select("row_index", "label", F.size("front_rgb").cast("long").alias("n_values"), total.alias("total"))


QUERIES = {
    f.__name__: f
    for f in (
        format_metric, format_metric_unstepped, metric_names, parse_metric, parse_metric_prose, parse_arch_metric,
        parse_step, thin_log, attach_primary_metric, last_metric, best_metric, distinct_metrics, write_metric_lines,
        read_train_log, stream_metrics, stream_run_table, write_read_frames, dataset_meta, read_windows, read_windows_from_frames,
        stream_ingest_frames, stream_stuck_actions, quantize_u8, quantize_array, dequantize_u8, hwc_to_chw,
        hwc_to_chw_bytes, resize_images, coerce_image, row_bytes, image_columns, normalized_columns, size_budget,
        split_state, split_state_with_pose, assemble_state_terms, object_pose, motors_to_state, action_to_columns,
        rename_image_columns, signature, dataset_id, recording_id, select_rows, select_indexed, restored_order, merge_sources,
        renumber_episodes, record_dataset, stream_recording, stream_rate_audit, image_stats, filtered_dataset_meta, shape_report, snapshot_windows, snapshot_by_file, persisted_frames, converted_windows, cached_frames,
    )
}
