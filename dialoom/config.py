"""Options, as plain frozen dataclasses.  They live on the driver only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from dialoom import fixed_values as fixed


@dataclass(frozen=True)
class PreprocessOptions:
    """Row-local cleaning.  Cutting reference sections, sizing, the size cap and the
    final both-roles check have no switch: they always run."""

    validate: bool = True
    strip: bool = True
    check_charset: bool = True
    drop_rejections: bool = True
    drop_duplicates: bool = True
    system_prompt: str = fixed.DEFAULT_SYSTEM_PROMPT
    strip_phrases: Sequence[str] = fixed.STRIP_PHRASES
    cut_markers: Sequence[str] = fixed.CUT_MARKERS
    section_headers: Sequence[str] = fixed.SECTION_HEADERS
    rejection_phrases: Sequence[str] = fixed.REJECTION_PHRASES
    code_points: Sequence[int] = fixed.CODE_POINTS
    charset_threshold: float = 0.95
    max_nbytes: int = 64_000


@dataclass(frozen=True)
class FilterOptions:
    """Near duplicates, thinning by score and binning."""

    dedup: bool = False
    thin: bool = False
    similarity_threshold: float = 0.80
    first_filter: str = "kl"
    second_filter: str = "ner"
    boost: float = 1.0
    force_num_bins: int | None = None
    # most vectors in a block of the near-duplicate search
    tile_rows: int = 1024
    # "unmatched": any earlier record drops a near one; "independent": only one that stays
    survivors: str = "unmatched"


@dataclass(frozen=True)
class RewriteOptions:
    """Data side of model-assisted rewriting of system prompts."""

    enabled: bool = False
    twice: bool = False
    context_size: int = 16_384
    instruction: str = (
        "Write a short system prompt, in the first person, that would lead to the "
        "responses in the conversation below. Keep every rule and fact that the current "
        "system prompt states. Answer with the new system prompt only."
    )
    stop_markers: Sequence[str] = fixed.GENERATION_STOP_MARKERS
    min_characters: int = 10
    # tries of a prompt that fails alone, after the first one
    retries: int = 1
    # a task or slice with a larger share of failed prompts stops the run
    max_error_share: float = 0.5
    # parts of a resumable run that are saved one by one
    slices: int = 64


@dataclass(frozen=True)
class OutputOptions:
    balance: bool = False
    test_ratio: float = 0.1
    # keep the records of the largest size in the last bin instead of losing them
    include_max: bool = True
    save_json: bool = True
    save_jsonl: bool = True
    train_name: str = "train"
    test_name: str = "test"
    total_name: str = "total"
    # positions per part file of an ordered set
    rows_per_file: int = 100_000


@dataclass(frozen=True)
class CurateOptions:
    preprocess: PreprocessOptions = field(default_factory=PreprocessOptions)
    filtering: FilterOptions = field(default_factory=FilterOptions)
    rewrite: RewriteOptions = field(default_factory=RewriteOptions)
    output: OutputOptions = field(default_factory=OutputOptions)
    # phrase -> alternatives, applied in order
    swaps: Mapping[str, Sequence[str]] = field(default_factory=dict)
    embedding_dimensions: int = 64
    store_path: str | None = None
    # table of what has been rewritten, for a run that goes on after a stop
    rewrite_path: str | None = None
    seed: int = 7
