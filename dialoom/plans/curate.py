"""The whole run, from raw records to train, test and total sets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dialoom.config import CurateOptions
from dialoom.functions import messages as M
from dialoom.operators import bins as B
from dialoom.operators.balance import balance_bins, curriculum_shuffle
from dialoom.operators.clean import size_and_cap, swap_phrases
from dialoom.operators.documents import build_documents, upsert_documents
from dialoom.operators.duplicates import near_duplicates
from dialoom.operators.embed import embed_hashed, with_embeddings
from dialoom.operators.ranking import rank_by_range
from dialoom.operators.rewrite import Generator, improve_system_prompts, resume_processing
from dialoom.operators.split import split_by_segment, split_by_size_bin
from dialoom.plans.preprocess import preprocess
from dialoom.session import Stages, stage_table
from dialoom.sources.records import append_unmodified
from dialoom.sources.sinks import drop_embedding_column


@dataclass
class Curated:
    """``total`` holds every record that is left, ``split`` the train and test ones; both
    have the ``position`` that the sinks write them in: the curriculum's, or that by size."""

    total: DataFrame
    split: DataFrame
    nbins: int
    counts: dict[str, int]


def curate(
    df: DataFrame,
    options: CurateOptions | None = None,
    embed: Callable[[DataFrame], DataFrame] | None = None,
    make_generator: Callable[[], Generator] | None = None,
    unmodified: DataFrame | None = None,
) -> Curated:
    """Curate raw records with ``conv_id``.

    ``unmodified`` records (``conv_id``, ``conversation`` as clean structs) skip
    everything up to the final size cap.  Results of the expensive steps are written to
    the shared folder once and read from there.
    """
    options = options or CurateOptions()
    f, out = options.filtering, options.output
    if options.rewrite.enabled and make_generator is None:
        raise ValueError("rewriting is on, but there is no generator")
    stages = Stages(df.sparkSession)
    read = Observation()
    # the raw input is read once: it is counted while it is cleaned and written
    seen = df.observe(read, F.count(F.lit(1)).alias("n"))
    records = stages.table(preprocess(seen, options.preprocess), "preprocessed")
    counts = {"input": read.get["n"], "preprocessed": records.count()}

    if f.dedup or f.thin or options.store_path:
        embed = embed or (lambda rows: embed_hashed(rows, options.embedding_dimensions))
        records = stages.table(with_embeddings(records, embed), "embedded")
        if options.store_path:
            counts["stored"] = upsert_documents(build_documents(records), options.store_path)
        if f.dedup:
            binning = B.optimal_bins(records, f.force_num_bins)
            if binning is not None:
                # id, size and vector decide; the records follow in one join
                narrow = records.select("conv_id", "nbytes", "embedding")
                kept = near_duplicates(
                    B.assign_bins(narrow, binning),
                    f.similarity_threshold,
                    f.tile_rows,
                    f.survivors,
                ).select("conv_id")
                records = stages.table(
                    records.join(kept, "conv_id", "left_semi"), "deduplicated"
                )
        counts["deduplicated"] = records.count()

    binning = B.optimal_bins(records, f.force_num_bins)
    nbins = binning.nbins if binning else 0
    if f.thin and binning is not None:
        records = B.histogram_filter(
            B.assign_bins(records, binning),
            nbins,
            f.boost,
            f.first_filter,
            f.second_filter,
            options.seed,
        ).drop("bin")
    records = drop_embedding_column(records)
    if options.rewrite.enabled:
        if options.rewrite_path:
            # what an earlier, stopped run has rewritten is read back, not generated again
            records = resume_processing(
                records, options.rewrite_path, make_generator, options.rewrite
            )
        else:
            records = improve_system_prompts(records, make_generator, options.rewrite)
    records = swap_phrases(records, options.swaps, options.seed).drop("nbytes")
    if unmodified is not None:
        records = append_unmodified(records, unmodified)
    total = stages.table(
        size_and_cap(records, options.preprocess.max_nbytes), "final", keep=True
    )
    stages.drop()
    counts["final"] = total.count()

    if out.balance and nbins:
        narrow = total.select("conv_id", "nbytes")
        balanced, target = balance_bins(narrow, nbins, options.seed, out.include_max)
        ordered = stage_table(
            curriculum_shuffle(balanced, target, options.seed), "curriculum"
        )
        parts = split_by_segment(ordered, nbins, out.test_ratio, options.seed)
        place = stage_table(
            parts.select("conv_id", "position", "chunk", "segment", "split"), "placed"
        )
    else:
        narrow = total.select("conv_id", "nbytes")
        parts = split_by_size_bin(
            narrow, max(1, nbins), out.test_ratio, options.seed, out.include_max
        ).select("conv_id", "split")
        ranked = rank_by_range(narrow, ["nbytes", "conv_id"], "position").drop("nbytes")
        place = stage_table(ranked.join(parts, "conv_id", "left"), "placed")
    # one join of the full rows, written once for all sinks, which sort by position
    total = stage_table(total.join(place, "conv_id"), "ordered")
    split = total.where(F.col("split").isNotNull())
    return Curated(total, split, nbins, counts)


def report(curated: Curated) -> DataFrame:
    """``(split, cnt)`` of the final sets."""
    whole = curated.total.agg(F.count(F.lit(1)).alias("cnt"))
    return whole.select(F.lit("total").alias("split"), "cnt").unionByName(
        curated.split.groupBy("split").agg(F.count(F.lit(1)).alias("cnt"))
    )


def message_rows(df: DataFrame) -> DataFrame:
    """Records → one row per message: ``(conv_id, pos, role, value)``."""
    return df.select(
        "conv_id", F.posexplode(M.project_messages(F.col("conversation"))).alias("pos", "m")
    ).select("conv_id", F.col("pos").cast("bigint").alias("pos"), "m.*").withColumnRenamed(
        "from", "role"
    )
