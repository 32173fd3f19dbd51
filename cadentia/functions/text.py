"""Text forms: observation patterns, model tags, metadata, telemetry keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadentia.functions.hashing import let_sql

# Forms of a model tag, best first. Even ranks carry a version
# (or a time), odd ranks are the same family with an unreadable version.
TAG_RANKS = {
    "final": 0,
    "final_malformed": 1,
    "round": 2,
    "round_malformed": 3,
    "timestamp": 4,
    "timestamp_malformed": 5,
    "test": 6,
    "test_malformed": 7,
    "other": 99,
}
TAG_TIME_FORMAT = "yyyyMMdd_HHmmss"
ARTIFACT_PATTERN = r"(?:^|/)vae_(encoder|decoder)_([^/]+)\.keras$"
CADENCE_FILE_PATTERN = r"(?:^|/)cadence_(\d+)_obs_(\d+)\.npy$"


def pattern_string(pattern: Column) -> Column:
    """``[0, 2, 4]``"""
    return F.concat(F.lit("["), F.array_join(pattern.cast("array<string>"), ", "), F.lit("]"))


def tag_rank(tag: str) -> Column:
    """Struct ``(rank, version)`` of a tag column; a tag without a readable version has none."""
    ranks = ", ".join(f"'{name}', {rank}" for name, rank in TAG_RANKS.items())
    form = f"""case
        when startswith({tag}, 'final_') then 'final'
        when startswith({tag}, 'round_') then 'round'
        when {tag} rlike '^[0-9]{{8}}_[0-9]{{6}}' then 'timestamp'
        when startswith({tag}, 'test_') then 'test'
        else 'other' end"""
    part = f"trim(get(split({tag}, if(f = 'round', '_', '_v')), 1))"
    number = let_sql("t", part, "if(t rlike '^[+-]?[0-9]+$', try_cast(t as bigint), null)")
    stamp = f"""if({tag} rlike '^[0-9]{{8}}_[0-9]{{6}}$',
        unix_seconds(try_to_timestamp({tag}, '{TAG_TIME_FORMAT}')), null)"""
    version = f"case f when 'timestamp' then {stamp} when 'other' then null else {number} end"
    name = "if(f = 'other' or v is not null, f, concat(f, '_malformed'))"
    ranked = f"named_struct('rank', map({ranks})[{name}], 'version', v)"
    return F.expr(let_sql("f", form, let_sql("v", version, ranked)))


def metadata_json(**fields: Column) -> Column:
    """JSON object text with its keys in sorted order."""
    return F.to_json(F.struct(*[fields[name].alias(name) for name in sorted(fields)]))


def series_key(resource_type: Column, resource_name: Column) -> Column:
    return F.concat_ws("_", resource_type, resource_name)
