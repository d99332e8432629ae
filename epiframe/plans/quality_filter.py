"""The quality filter: length, then smoothness and deviation, then an absolute guard."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.operators.chunked import dense_lengths, join_by_chunk
from epiframe.operators.episodes import MIN_EPISODE_LENGTH, add_timestamp
from epiframe.operators.ordered import ROWS_PER_CLASS, percentile_of, rank_below
from epiframe.operators.quality import sal, ted
from epiframe.schema import EPISODE, FPS, POSITION, named
from epiframe.sources.frames import DatasetNotFound, read_frames, write_dataset_meta, write_frames
from epiframe.storage import exists, is_complete, pin

# Defaults of the filter.
SAL_THRESHOLD = 0.2
TED_THRESHOLD = 2.0
SCORE_DECIMALS = 9
STRATEGIES = ("composite", "sal", "ted")


def badness(
    scores: DataFrame, strategy: str, keys: Sequence[str], rows: int, rows_per_class: int = ROWS_PER_CLASS
) -> DataFrame:
    """Add a rank in [0, 1] per episode, 1 being the worst (the composite is ours).

    Scores are compared to nine decimals, so that the last bits of a sum do not
    order two equal episodes.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {STRATEGIES}, not {strategy!r}")
    ranked = scores.withColumn("_sal", -F.round("sal", SCORE_DECIMALS)).withColumn("_ted", F.round("ted", SCORE_DECIMALS))
    used = {"composite": ["_sal", "_ted"], "sal": ["_sal"], "ted": ["_ted"]}[strategy]
    for name in used:
        ranked = rank_below(ranked, name, f"{name}_rank", keys, rows, rows_per_class)
    percent = [F.col(f"{name}_rank") / F.lit(float(max(rows - 1, 1))) for name in used]
    return ranked.withColumn("badness", sum(percent[1:], percent[0]) / len(used)).select(*scores.columns, "badness")


def judge_episodes(
    frames: DataFrame,
    dims: int,
    sal_threshold: float = SAL_THRESHOLD,
    ted_threshold: float = TED_THRESHOLD,
    min_episode_length: int = MIN_EPISODE_LENGTH,
    strategy: str = "composite",
    action: str = "action",
    keys: Sequence[str] = EPISODE,
    pos: str = POSITION,
    fps: float = FPS,
    rows_per_class: int = ROWS_PER_CLASS,
    lengths: DataFrame | None = None,
) -> DataFrame:
    """One row per episode of sufficient length: scores, badness, and whether it is kept.

    Scores are pinned, as ranks, the cut and the result must all see the same values.
    ``lengths`` is the table of episode lengths, if it has been computed and pinned. An
    episode that cannot be scored (a null, NaN or infinite action) is not kept and has no
    badness; the others are ranked without it.
    """
    if lengths is None:
        lengths = dense_lengths(frames, keys, pos)
    long_enough = lengths.where(F.col("length") >= min_episode_length)
    episodes, longest = long_enough.agg(F.count("*"), F.coalesce(F.max("length"), F.lit(0))).first()
    narrow = frames.select(*keys, pos, named(action))
    scored = join_by_chunk(narrow, long_enough, keys, pos, how="left_semi", keyed_rows=episodes)
    smoothness = sal(scored, dims, action, keys, pos, fps, longest=longest)
    deviation = ted(scored, dims, action, keys, pos)
    every = pin(smoothness.join(deviation, list(keys)).join(long_enough, list(keys)))
    unscored = F.coalesce(F.isnan("sal") | F.isnan("ted"), F.lit(True))
    scores = every.where(~unscored)
    rows = scores.count()
    ranked = pin(badness(scores, strategy, keys, rows, rows_per_class))
    percent = int(sal_threshold * 100)
    kept = F.col("ted") <= ted_threshold
    if percent > 0:
        cut = percentile_of(ranked, "badness", 1 - percent / 100, rows, rows_per_class)
        if cut is not None:
            kept = kept & (F.col("badness") <= F.lit(cut))
    left_out = every.where(unscored).withColumns({"badness": F.lit(None).cast("double"), "kept": F.lit(False)})
    return ranked.withColumn("kept", kept).unionByName(left_out)


@dataclass
class FilterReport:
    kept: int
    removed: int
    dry_run: bool


def quality_filter(frames: DataFrame, dims: int, **options) -> tuple[DataFrame, DataFrame]:
    """Frames of the kept episodes, and a one-row report (kept, removed)."""
    keys = options.get("keys", EPISODE)
    pos = options.get("pos", POSITION)
    lengths = dense_lengths(frames, keys, pos)
    kept = judge_episodes(frames, dims, lengths=lengths, **options).where("kept")
    episodes = lengths.count()
    report = kept.agg(F.count("*").alias("kept")).withColumn("removed", F.lit(episodes) - F.col("kept"))
    return join_by_chunk(frames, kept, keys, pos, how="left_semi", keyed_rows=episodes), report


def filter_dataset(
    spark: SparkSession, path: str, dims: int, output: str | None = None, dry_run: bool = False, **options
) -> FilterReport:
    """Filter a stored dataset into ``<path>_filtered``, with side tables of what is kept; a dry run writes nothing.

    Features and frame rate are those of the dataset's own side tables; without these, the action's and ``fps``.
    """
    if not exists(spark, path):
        raise DatasetNotFound(path)
    frames, report = quality_filter(read_frames(spark, path, schema=None), dims, **options)
    counts = report.first()
    if not dry_run:
        out = output or f"{path.rstrip('/')}_filtered"
        write_frames(frames, out)
        base = path.rstrip("/")
        sizes, fps = {options.get("action", "action"): dims}, options.get("fps", FPS)
        if is_complete(spark, f"{base}/stats") and is_complete(spark, f"{base}/info"):
            # one row per feature and dimension
            sizes = {r["feature"]: r["n"] for r in spark.read.parquet(f"{base}/stats").groupBy("feature").agg((F.max("dim") + 1).alias("n")).collect()}
            fps = spark.read.parquet(f"{base}/info").first()["fps"]
        kept = read_frames(spark, out, schema=None)
        write_dataset_meta(kept if "timestamp" in kept.columns else add_timestamp(kept, fps), out, sizes, fps)
    return FilterReport(counts["kept"], counts["removed"], dry_run)
