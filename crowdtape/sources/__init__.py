"""Readers and writers: raw post lines, price files, labelled posts, snapshots."""

from crowdtape.sources.csv_records import read_records
from crowdtape.sources.labeled import label_posts, read_labeled_posts
from crowdtape.sources.lexicon import read_lexicon
from crowdtape.sources.manifest import content_hash, differences, input_files
from crowdtape.sources.prices import read_prices
from crowdtape.sources.raw_posts import (
    accepted_posts,
    parse_posts,
    read_raw_posts,
    rejected_lines,
    split_fields,
)
from crowdtape.sources.snapshot import (
    between_dates,
    is_complete,
    load_or_build,
    month_of,
    overwrite_partitions,
    write_series,
)

__all__ = [
    "accepted_posts",
    "between_dates",
    "content_hash",
    "differences",
    "input_files",
    "is_complete",
    "label_posts",
    "load_or_build",
    "month_of",
    "overwrite_partitions",
    "parse_posts",
    "read_labeled_posts",
    "read_lexicon",
    "read_prices",
    "read_raw_posts",
    "read_records",
    "rejected_lines",
    "split_fields",
    "write_series",
]
