"""Scalar expressions: text, numbers, paths and names.  All stay in the JVM and are free of side effects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import vocabulary as v



def text(value: Column) -> Column:
    """Trimmed text; a missing value is blank."""
    return F.trim(F.coalesce(value.cast("string"), F.lit("")))


def is_blank(value: Column) -> Column:
    return text(value) == ""


def blank_to_null(value: Column) -> Column:
    return F.when(text(value) != "", value)


def truthy(value: Column) -> Column:
    """Booleans as text: one definition for all stages; anything unknown or missing is false."""
    return F.lower(text(value)).isin(*v.TRUE_WORDS)


def double_or(value: Column, default: float) -> Column:
    return F.coalesce(text(value).try_cast("double"), F.lit(default))


def int_or(value: Column, default: int = 0) -> Column:
    """Text of any number, cut to its whole part."""
    return F.coalesce(text(value).try_cast("double").try_cast("int"), F.lit(default))


def band_of(field: Column) -> Column:
    """The band that a field names or begins to describe; anything else is an error."""
    s = text(field)
    out = F.when(s.isin(*v.BANDS), s)
    for prefix, name in v.BAND_PREFIXES.items():
        out = out.when(s.startswith(prefix), F.lit(name))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown band: "), s)).cast("string"))


def folder_name(rank: Column, name: Column) -> Column:
    safe = F.regexp_replace(F.replace(text(name), F.lit(" "), F.lit("_")), r"[^A-Za-z0-9_\-]", "")
    return F.concat(F.format_string("%04d", rank.cast("int")), F.lit("_"), safe)


def query_text(name: Column, suffix: str) -> Column:
    return F.concat(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"[ \t\n\x0B\f\r]+", " ")), F.lit(" " + suffix))


def domain(url: Column) -> Column:
    """Authority in lower case, with port and user; blank where the URL has none."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("AUTHORITY"))), F.lit(""))


def extension(url: Column, fmt: Column | None = None) -> Column:
    """Extension of a decoded format, else of the URL's path if it is an image's, else ``.jpg``."""
    own = F.lower(F.regexp_extract(F.split_part(F.coalesce(url, F.lit("")), F.lit("?"), F.lit(1)), r"(\.[^./]*)$", 1))
    out = F.when(own.isin(*v.URL_EXTENSIONS), own).otherwise(F.lit(".jpg"))
    if fmt is None:
        return out
    known = F.when(fmt == "JPEG", ".jpg").when(fmt == "PNG", ".png").when(fmt == "WEBP", ".webp")
    return F.coalesce(known, out)


def suffix_of(path: Column) -> Column:
    """Suffix of the last path component, in lower case; blank without one."""
    return F.lower(F.regexp_extract(F.coalesce(path, F.lit("")), r"[^/](\.[^./]+)$", 1))


def stem_of(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]+$", "")


def output_extension(source_used: Column, source_path: Column, has_alpha: Column) -> Column:
    """Painted sources become PNG; others keep a known extension, else one that fits their pixels."""
    own = suffix_of(source_path)
    return F.when(source_used == "inpainted", ".png").when(own.isin(*v.SHARD_EXTENSIONS), own).when(has_alpha, ".png").otherwise(".jpg")


def md5_in(token: Column) -> Column:
    """The first run of 32 hexadecimal digits, in lower case; null without one."""
    return F.nullif(F.lower(F.regexp_extract(token, "([a-fA-F0-9]{32})", 1)), F.lit(""))


def path_part(path: Column, from_end: int) -> Column:
    """A component counted from the end: 1 is the file; null where the path is shorter."""
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


def resolve(root: str, path: Column) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_id(prefix: str, ts: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), F.date_format(ts, "yyyyMMdd_HHmmss"))


def size_text(w: Column, h: Column) -> Column:
    """``WxH`` where both are known and positive, else blank."""
    return F.when((w > 0) & (h > 0), F.concat_ws("x", w.cast("string"), h.cast("string"))).otherwise("")


def parse_size(size: Column) -> Column:
    """Struct (w, h) of ``WxH``; both null unless both are positive."""
    part = F.split(F.lower(text(size)), "x")
    w, h = (F.trim(F.get(part, F.lit(i))).try_cast("int") for i in (0, 1))
    ok = (F.size(part) == 2) & (w > 0) & (h > 0)
    return F.struct(F.when(ok, w).alias("w"), F.when(ok, h).alias("h"))


def resolution(new_w: Column, new_h: Column, w: Column, h: Column) -> Column:
    whole = (new_w > 0) & (new_h > 0)
    return F.when(whole, new_w.cast("long") * new_h).otherwise(F.coalesce(w.cast("long") * h, F.lit(0)))


def hash_of_hex(hex16: Column) -> Column:
    """A 64-bit hash from 16 hexadecimal digits; null where the text is none."""
    s = F.lower(text(hex16))
    return F.when(s.rlike("^[0-9a-f]{1,16}$"), F.conv(s, 16, -10).cast("long"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def aspect(w: Column, h: Column) -> Column:
    """Long side over short side to 6 places, 0 where a side is 0."""
    short = F.least(w, h)
    return F.when(short > 0, F.bround(F.greatest(w, h) / short, 6)).otherwise(F.lit(0.0))


def target_size(w: Column, h: Column, strict: bool = False) -> Column:
    """Struct (new_w, new_h, scale, kernel, action) of the resize policy.

    Short sides below 1024 are raised to it; short sides above 2048 or long sides above 4096 scale the short side to
    2048, which enlarges very long pictures.  ``strict`` instead never enlarges there and honours both caps.
    Halves round to even.
    """
    short, long_ = F.least(w, h), F.greatest(w, h)
    up, down = short < v.TARGET_MIN, (short > v.CAP_MIN) | (long_ > v.CAP_LONG)
    cap = F.lit(float(v.CAP_MIN)) / short
    if strict:
        cap = F.least(cap, F.lit(float(v.CAP_LONG)) / long_)
    scale = F.when(up, F.lit(float(v.TARGET_MIN)) / short).when(down, cap).otherwise(F.lit(1.0))
    fresh = F.when(up | down, F.lit(True)).otherwise(False)
    return F.struct(
        F.when(fresh, F.bround(w * scale).cast("int")).otherwise(w.cast("int")).alias("new_w"),
        F.when(fresh, F.bround(h * scale).cast("int")).otherwise(h.cast("int")).alias("new_h"),
        scale.alias("scale"),
        F.when(up, "BICUBIC").when(down & (scale < 0.5), "AREA").when(down, "BICUBIC").otherwise("KEEP").alias("kernel"),
        F.when(up, "upscale_to_1024").when(down, "downscale_to_2048").otherwise("keep").alias("action"),
    )


def effective_score(rel: Column, aes: Column, low: float = 0.85, at: float = 60.0) -> Column:
    """Aesthetic score weakened by low relevance: factor 0.85 at 60, 1 from 100 on."""
    return aes * F.least(F.lit(1.0), F.greatest(F.lit(low), F.lit(low) + F.lit(1.0 - low) * (rel - at) / F.lit(40.0)))


def number(value: Column) -> Column:
    """A double whose NaN is missing: comparisons with it fail as they should."""
    d = value.cast("double")
    return F.when(~F.isnan(d), d)


def data_url(name: Column, content: Column) -> Column:
    """A data URL on one line; Spark's base64 breaks lines after 76 characters."""
    s = suffix_of(name)
    mime = F.when(s == ".png", "image/png").when(s == ".webp", "image/webp").otherwise("image/jpeg")
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.replace(F.base64(content), F.lit("\r\n"), F.lit("")))


def snake(value: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 as one underscore, none at the ends."""
    s = F.regexp_replace(F.lower(text(value)), "[^a-z0-9]+", "_")
    return F.regexp_replace(s, "^_+|_+$", "")


def list_of(value: Column) -> Column:
    """Comma-separated names, trimmed and lower-cased, without blanks."""
    return F.filter(F.transform(F.split(F.lower(F.coalesce(value, F.lit(""))), ","), lambda x: F.trim(x)), lambda x: x != "")


def joined(names: Column) -> Column:
    return F.array_join(F.array_distinct(names), ", ")


def sentence(value: Column, most_words: int = 28) -> Column:
    """One clean sentence: no quotes around it, single spaces, the first sentence only, an end mark, 28 words at most."""
    s = F.regexp_replace(F.coalesce(value, F.lit("")), r"^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$", "")
    for mark in ("`", '"', "'"):
        s = F.regexp_replace(s, f"^{mark}+|{mark}+$", "")
    s = F.regexp_replace(s, r"[ \t\n\x0B\f\r]+", " ")
    s = F.trim(F.get(F.split(s, r"(?<=[.!?]) +"), F.lit(0)))
    s = F.when(s.rlike(r"[.!?]$"), s).otherwise(F.concat(s, F.lit(".")))
    words = F.filter(F.split(s, " "), lambda w: w != "")
    cut = F.concat(F.regexp_replace(F.array_join(F.slice(words, 1, most_words), " "), "[,;]+$", ""), F.lit("."))
    return F.when(F.size(words) > most_words, cut).otherwise(s)


def hit_text(hits: Column, least: float = 0.01) -> Column:
    """``tag:0.123;...`` of (tag, score) structs of at least ``least``."""
    return F.array_join(F.transform(F.filter(hits, lambda x: x["score"] >= least), lambda x: F.concat(x["tag"], F.lit(":"), F.format_string("%.3f", x["score"]))), ";")


def ranked_hits(scores: Column, tags: tuple[str, ...]) -> Column:
    """(tag, score) of the named tags with a positive score, highest first, ties in the order of ``tags``."""
    found = F.array_compact(F.array(*[F.when(F.element_at(scores, t) > 0, F.struct(F.element_at(scores, t).alias("score"), F.lit(t).alias("tag"), F.lit(i).alias("i"))) for i, t in enumerate(tags)]))
    return F.transform(F.array_sort(found, lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).otherwise(a["i"] - b["i"])), lambda x: F.struct(x["tag"].alias("tag"), x["score"].alias("score")))


def best_score(hits: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(hits, lambda x: x["score"])), F.lit(0.0))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda argument is not expanded into its uses."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
