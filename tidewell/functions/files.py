"""Column expressions for photo addresses, file names, run stamps and sidecars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PHOTO_HOST = "inaturalist"
SIZED = r"(?i)/(?:small|medium|large|original|square)\.(jpe?g|png|gif|webp)"
EXTENSIONS = ("jpg", "jpeg", "png", "gif", "webp")


def photo_url(url: Column, size: str = "large", host: str = PHOTO_HOST) -> Column:
    """The address of the photo in another size; null where the host isn't known."""
    return F.when(url.contains(host), F.regexp_replace(url, SIZED, f"/{size}.$1"))


def observation_id(reference: Column) -> Column:
    return F.nullif(F.regexp_extract(reference, r"observations/(\d+)", 1), F.lit("")).try_cast("bigint")


def url_hash(url: Column) -> Column:
    return F.substring(F.md5(url.cast("binary")), 1, 8)


def bucket(key: Column, buckets: int = 1000) -> Column:
    return F.lpad(F.pmod(key, F.lit(buckets)).cast("string"), 3, "0")


def extension(url: Column) -> Column:
    """Lower-case extension before any query; jpeg and unknown ones are jpg."""
    last = F.lower(F.split_part(F.element_at(F.split(url, r"\."), -1), F.lit("?"), F.lit(1)))
    return F.when(last.isin(*EXTENSIONS) & (last != "jpeg"), last).otherwise("jpg")


def photo_path(key: Column, url: Column) -> Column:
    return F.concat(bucket(key), F.lit("/"), key.cast("string"), F.lit("_"), url_hash(url), F.lit("."), extension(url))


def leading_id(name: Column) -> Column:
    """The number before the first underscore or dot of a file name; null if there is none."""
    return F.split_part(F.split_part(F.element_at(F.split(name, "/"), -1), F.lit("."), F.lit(1)), F.lit("_"), F.lit(1)).try_cast("bigint")


def run_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss")


def run_id(path: Column) -> Column:
    """The run of a shard by its file name; empty for legacy names."""
    return F.regexp_extract(path, r"embeddings_(\d{8}T\d{6})_", 1)


def sidecar_url(text: Column) -> Column:
    """The address in a sidecar, by either of its names; null where the JSON is malformed or has none."""
    return F.coalesce(F.get_json_object(text, "$.image_url_large"), F.get_json_object(text, "$.url"))


def content_sha256(content: Column) -> Column:
    return F.sha2(content, 256)
