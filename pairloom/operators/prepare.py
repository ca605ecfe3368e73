"""From annotation exports and query folders to one checked dataset."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.lexicon import CHINESE, Lexicon
from pairloom.operators.build import attach_payload, build_all_positives, build_from_annotations
from pairloom.operators.expand import expand_attributes, expand_variants
from pairloom.operators.filtering import filter_long
from pairloom.operators.merge import merge_datasets, require_consistent
from pairloom.operators.validate import require_valid
from pairloom.session import scratch_path
from pairloom.sources import annotations, folders, paths
from pairloom.sources.runs import Run, listing_key
from pairloom.sources.sinks import with_other_splits, write_dataset


@dataclass(frozen=True)
class PrepareSettings:
    joiner: str = "；"
    keep_empty: bool = False
    caption_ratio: float = 0.1
    max_caption_len: int = 55
    folder_ratio: float = 0.1
    seed: int = 42
    expand_splits: tuple[str, ...] = ("train",)
    variants_per_text: int = 2
    variant_min_len: int = 6
    variant_max_len: int = 45
    single_image_only: bool = True
    attribute_queries: int | None = None
    lexicon: Lexicon = CHINESE


Frames = tuple[DataFrame, DataFrame, DataFrame]


def prepare_frames(
    run: Run, exports: Callable[[], Frames], samples: Callable[[], Frames], settings: PrepareSettings = PrepareSettings()
) -> tuple[DataFrame, DataFrame]:
    """Build, filter, merge, expand and validate, in steps of ``run``.

    ``exports`` gives images, annotations and files, ``samples`` folders, queries
    and files; neither is called when its step is done.  Images stay (split,
    ord, image_id, path) rows.
    """
    s = settings
    built = run.steps(
        ["built_texts", "built_images"],
        lambda: build_from_annotations(
            *exports(), joiner=s.joiner, keep_empty=s.keep_empty, ratio=s.caption_ratio, seed=s.seed
        ),
    )
    if built[0].isEmpty():
        raise ValueError("No valid samples found. Check input paths or annotations.")
    base = run.steps(["base_texts", "base_images"], lambda: filter_long(*built, s.max_caption_len))

    def positives():
        texts, images, _ = build_all_positives(*samples(), ratio=s.folder_ratio, seed=s.seed)
        return texts, images.select("split", "ord", "image_id", "path")

    added = run.steps(["added_texts", "added_images"], positives)
    texts, images = run.steps(
        ["merged_texts", "merged_images"], lambda: [f.drop("origin") for f in merge_datasets(*base, *added)]
    )
    run.once("consistent", lambda: require_consistent(texts, images))

    def expanded():
        chosen = list(s.expand_splits)
        grown = texts.where(F.col("split").isin(*chosen))
        if s.attribute_queries is not None:
            grown = expand_attributes(grown, s.attribute_queries, lex=s.lexicon).drop("derived", "source_ord")
        grown = expand_variants(
            grown,
            max_new=s.variants_per_text,
            min_len=s.variant_min_len,
            max_len=s.variant_max_len,
            single_image_only=s.single_image_only,
            lex=s.lexicon,
        )
        return with_other_splits(grown, texts, chosen)

    texts = run.step("expanded_texts", expanded)
    run.once("valid", lambda: require_valid(texts, images))
    return texts, images


def prepare_dataset(
    spark: SparkSession,
    export_folders: list[str],
    sample_root: str,
    out: str,
    settings: PrepareSettings = PrepareSettings(),
    *,
    work: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """From files to a written dataset.

    Image bytes are read once, at the end, for the images that are still
    referenced.  ``work`` names a folder that keeps the steps: a run that broke
    off is called again with it and goes on at the first step that is not done,
    and a run that ended gives its frames without writing again.
    """
    folder, identity = work, {}
    if work is None:
        folder = scratch_path(spark, "run")
    else:
        roots = [*export_folders, sample_root]
        for root in roots:
            paths.require(spark, root)
        identity = {"inputs": roots, "files": listing_key(spark, roots), "out": out, "settings": repr(settings)}
    if paths.exists(spark, out) and not (work and paths.exists(spark, f"{work}/done/writing.json")):
        raise FileExistsError(f"Output directory already exists: {out}")
    run = Run(spark, folder, identity)

    def exports() -> Frames:
        read = annotations.read_exports(spark, export_folders)
        files = annotations.export_files(spark, export_folders)
        return annotations.export_images(read), annotations.export_annotations(read), files

    def samples() -> Frames:
        readers = (folders.read_samples, folders.read_queries, folders.read_folder_files)
        return tuple(read(spark, sample_root) for read in readers)

    texts, images = prepare_frames(run, exports, samples, settings)

    def write() -> None:
        payload = annotations.export_files(spark, export_folders, content=True).unionByName(
            folders.read_folder_files(spark, sample_root, content=True).select("path", "content")
        )
        # what is there can only be what this run left when it broke off
        paths.remove(spark, out)
        write_dataset(texts, attach_payload(images, payload), out)

    run.once("writing", lambda: None)
    run.once("dataset", write)
    return texts, images
