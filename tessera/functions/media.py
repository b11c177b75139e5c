"""Media-file column functions: extension tests, MIME lookup, analysis order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference behaviour) -------------------
VIDEO_EXTENSIONS = [".mp4", ".mov", ".mpeg", ".webm"]
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".gif", ".webp"]
SUPPORTED_EXTENSIONS = VIDEO_EXTENSIONS + IMAGE_EXTENSIONS
MIME_TYPES = {
    ".mp4": "video/mp4",
    ".mov": "video/quicktime",
    ".mpeg": "video/mpeg",
    ".webm": "video/webm",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
    ".gif": "image/gif",
    ".webp": "image/webp",
}
DEFAULT_MIME = "application/octet-stream"
MAX_SLIDES = 12
SINGLE_VIDEO_NAME = "video.mp4"
SINGLE_IMAGE_NAME = "image.jpg"
# ---------------------------------------------------------------------------


def extension(name: Column) -> Column:
    """Lower-cased suffix including the dot ('' when none), like Path.suffix."""
    ext = F.regexp_extract(name, r"(\.[^./]*)$", 1)
    # A leading-dot name such as '.mp4' has no suffix in pathlib.
    return F.when(F.regexp_like(name, F.lit(r"^\.[^.]*$")), F.lit("")).otherwise(F.lower(ext))


def is_supported(name: Column) -> Column:
    return extension(name).isin(SUPPORTED_EXTENSIONS)


def is_video(name: Column) -> Column:
    return extension(name).isin(VIDEO_EXTENSIONS)


def mime_type(name: Column) -> Column:
    m = F.create_map(*[x for k, v in MIME_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, extension(name)), F.lit(DEFAULT_MIME))


def select_media(names: Column, max_slides: int = MAX_SLIDES) -> Column:
    """Analysis order of a post's files: video.mp4 alone, else image.jpg alone,
    else the supported files sorted by name, capped at max_slides."""
    return (F.when(F.array_contains(names, SINGLE_VIDEO_NAME), F.array(F.lit(SINGLE_VIDEO_NAME)))
            .when(F.array_contains(names, SINGLE_IMAGE_NAME), F.array(F.lit(SINGLE_IMAGE_NAME)))
            .otherwise(F.slice(F.array_sort(F.filter(names, is_supported)), 1, max_slides)))


def video_subset(media: Column) -> Column:
    return F.filter(media, is_video)


def media_type_label(media: Column) -> Column:
    """none / video / image / carousel from list size and first item."""
    return (F.when(F.size(media) == 0, "none")
            .when(F.size(media) == 1,
                  F.when(is_video(F.element_at(media, 1)), "video").otherwise("image"))
            .otherwise("carousel"))
