from starloom.operators.evidence import paired_gain
from starloom.operators.key_filter import KeyFilter
from starloom.operators.keys import with_dense_id, with_dense_id_in_place, with_identity
from starloom.operators.latest import latest_by
from starloom.operators.quality import (
    duplicate_report,
    duplicate_report_by_hash,
    duplicates,
    duplicates_by_hash,
    duplicates_of_ids,
    length_report,
    length_violations,
    null_report,
    null_violations,
)
from starloom.operators.star import (
    PlayFactors,
    artist_versions,
    artists,
    build_star,
    play_factors,
    songplay,
    songs,
    time_dim,
    user_versions,
    users,
)

__all__ = [
    "KeyFilter",
    "PlayFactors",
    "artist_versions",
    "artists",
    "build_star",
    "duplicate_report",
    "duplicate_report_by_hash",
    "duplicates",
    "duplicates_by_hash",
    "duplicates_of_ids",
    "latest_by",
    "length_report",
    "length_violations",
    "null_report",
    "null_violations",
    "paired_gain",
    "play_factors",
    "songplay",
    "songs",
    "time_dim",
    "user_versions",
    "users",
    "with_dense_id",
    "with_dense_id_in_place",
    "with_identity",
]
