"""Scalar column functions of the catalogue: parsing, naming, formatting, hashing, pricing, status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def duration_seconds(text: Column) -> Column:
    """`MM:SS` or `HH:MM:SS` to seconds; anything else is 0."""
    parts = F.transform(F.split(F.trim(text), ":"), lambda p: p.try_cast("bigint"))
    whole = F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, p: acc * 60 + p)
    return F.coalesce(F.when(F.size(parts).isin(2, 3), whole), F.lit(0).cast("bigint"))


def view_count(text: Column) -> Column:
    """`1,234 views`, `1.5K views`, `10.5M views`, `2.5B` to a count; anything else is 0."""
    t = F.regexp_replace(F.lower(F.trim(text)), ",", "")
    number = F.regexp_extract(t, r"^([0-9]*\.?[0-9]+)\s*([kmb]?)\s*(?:views?)?$", 1)
    unit = F.regexp_extract(t, r"^([0-9]*\.?[0-9]+)\s*([kmb]?)\s*(?:views?)?$", 2)
    scale = F.when(unit == "k", 1_000).when(unit == "m", 1_000_000).when(unit == "b", 1_000_000_000).otherwise(1)
    return F.coalesce((number.try_cast("decimal(20,6)") * scale).try_cast("bigint"), F.lit(0).cast("bigint"))


def platform_of(url: Column) -> Column:
    u = F.lower(url)
    return F.when(u.contains("youtube") | u.contains("youtu.be"), "youtube").otherwise("unknown")


def video_id_of(url: Column) -> Column:
    """What stands behind the last `youtu.be/` up to `?`, or behind the last `v=` up to `&`; else null."""
    u = F.lower(url)
    tail = lambda mark, stop: F.split_part(F.element_at(F.split(url, mark), -1), F.lit(stop), F.lit(1))
    return F.when(u.contains("youtu.be"), tail(r"youtu\.be/", "?")).when(u.contains("youtube") & url.contains("v="), tail("v=", "&"))


def url_hash(url: Column, chars: int = 64) -> Column:
    return F.substring(F.sha2(url, 256), 1, chars)


def job_key(platform: Column, video_id: Column, version: Column) -> Column:
    """The parts stay columns as well: the key cannot be split again where a part has an underscore."""
    return F.concat_ws("_", platform, video_id, version)


def episode_id(video_id: Column, index: Column) -> Column:
    return F.concat(video_id, F.lit("_ep"), F.when(index < 1000, F.lpad(index.cast("string"), 3, "0")).otherwise(index.cast("string")))


def parse_episode_id(episode: Column) -> tuple[Column, Column]:
    """(video id, index), split at the last `_ep`."""
    pattern = r"^(.*)_ep(\d+)$"
    return F.nullif(F.regexp_extract(episode, pattern, 1), F.lit("")), F.regexp_extract(episode, pattern, 2).try_cast("int")


def resolution_label(width: Column, height: Column) -> Column:
    # Heights that have a name of their own.
    named = F.when(height == 2160, "4K")
    for h in (1440, 1080, 720, 480, 360):
        named = named.when(height == h, f"{h}p")
    return F.when(width.isNotNull() & height.isNotNull(), named.otherwise(F.concat(width.cast("string"), F.lit("x"), height.cast("string"))))


def rational(text: Column) -> Column:
    """`num/den` or a number to a double; 0 where it is none or den is 0."""
    parts = F.transform(F.split(text, "/"), lambda p: p.try_cast("double"))
    return F.coalesce(F.when(F.size(parts) == 2, F.try_divide(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).otherwise(F.get(parts, F.lit(0))), F.lit(0.0))


def format_duration(seconds: Column) -> Column:
    said = lambda c, unit: F.format_string(f"%.1f{unit}", c.cast("double"))
    return F.when(seconds < 60, said(seconds, "s")).when(seconds < 3600, said(seconds / 60, "m")).otherwise(said(seconds / 3600, "h"))


def format_size(size: Column, largest: str = "PB") -> Column:
    """Bytes with two decimals and a unit, which is `largest` for all that is above. What is within 1e-9 below a half is rounded up."""
    said = lambda power, unit: F.format_string(f"%.2f {unit}", (size / 1024.0**power).cast("double") + (1e-9 if power else 0.0))
    units = ["B", "KB", "MB", "GB", "TB", "PB"]
    last = units.index(largest)
    out = F.when(size.isNull(), F.lit(None))
    for power, unit in enumerate(units[:last]):
        out = out.when(size < 1024.0 ** (power + 1), said(power, unit))
    return out.otherwise(said(last, largest))


def video_summary(name: Column, seconds: Column, width: Column, height: Column, fps: Column, codec: Column, audio: Column, size: Column) -> Column:
    """One line on a video; what is not known, or 0, is left out."""
    known = lambda test, said: F.when(F.coalesce(test, F.lit(False)), said)
    whole = F.floor(seconds)
    return F.array_join(F.array(
        F.concat(F.lit("File: "), name),
        known(seconds > 0, F.format_string("Duration: %dm %ds", F.floor(whole / 60), whole % 60)),
        known((width > 0) & (height > 0), F.format_string("Resolution: %dx%d", width, height)),
        known(fps > 0, F.format_string("FPS: %.2f", fps)),
        known(codec != "", F.concat(F.lit("Video Codec: "), codec)),
        known(audio != "", F.concat(F.lit("Audio Codec: "), audio)),
        known(size > 0, F.format_string("Size: %.2f MB", size / 1048576.0)),
    ), " | ")


def search_query(keywords: Column, operator: Column, platform: Column) -> Column:
    """The known platforms join with OR if asked to; all else joins with blanks."""
    joined = (F.upper(operator) == "OR") & F.lower(platform).isin("youtube", "vimeo")
    return F.when(joined, F.array_join(keywords, " OR ")).otherwise(F.array_join(keywords, " "))


def split_keywords(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda k: F.trim(k)), lambda k: k != "")


def error_id(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12)


def fingerprint(name: Column, labels: Column) -> Column:
    """Of a name and a map of labels, whatever their order."""
    said = F.array_join(F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return F.substring(F.md5(F.concat_ws("|", name, said)), 1, 16)


def params_hash(params: Column) -> Column:
    said = F.array_join(F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat(e["key"], F.lit(":"), F.coalesce(e["value"], F.lit("null")))), ",")
    return F.substring(F.md5(said), 1, 8)


def result_hash(content: Column) -> Column:
    """16 hex digits of the SHA-256, or '' where there is nothing."""
    return F.coalesce(F.substring(F.sha2(content, 256), 1, 16), F.lit(""))


# --- errors

# Exception type, error type, severity, retryable; the most specific first.
EXCEPTIONS = [
    ("TimeoutError", "network_timeout", "warning", "yes"),
    ("ConnectionRefusedError", "network_connection", "error", "yes"),
    ("ConnectionResetError", "network_connection", "warning", "yes"),
    ("ConnectionError", "network_connection", "warning", "yes"),
    ("ValueError", "data_validation", "warning", "no"),
    ("TypeError", "data_type_error", "error", "no"),
    ("KeyError", "data_missing", "warning", "no"),
    ("FileNotFoundError", "storage_not_found", "warning", "no"),
    ("PermissionError", "storage_permission", "error", "no"),
    ("OSError", "system_os", "error", "conditional"),
    ("MemoryError", "resource_memory", "critical", "conditional"),
]
# Status from, to, error type, severity, retryable.
STATUSES = [
    (401, 401, "auth_unauthorized", "error", "no"),
    (403, 403, "auth_forbidden", "error", "no"),
    (404, 404, "api_not_found", "warning", "no"),
    (429, 429, "api_rate_limit", "warning", "yes"),
    (400, 400, "api_bad_request", "warning", "no"),
    (500, 599, "api_server_error", "error", "yes"),
]


def classify_error(exc_type: Column, status: Column, message: Column) -> Column:
    """struct(error_type, severity, retryable): the exception's, then the status's, then what the message says."""

    def chain(rows, test, k, other):
        out = reduce(lambda acc, r: (F if acc is None else acc).when(test(r), r[k]), rows, None)
        return out.otherwise(other)

    low = F.lower(F.coalesce(message, F.lit("")))
    cols = []
    for k, name, unknown in ((1, "error_type", "unknown"), (2, "severity", "error"), (3, "retryable", "no")):
        by_type = chain(EXCEPTIONS, lambda r: exc_type == r[0], k, unknown)
        by_status = chain(STATUSES, lambda r: status.between(r[0], r[1]), k + 1, unknown)
        cols.append(F.when(status.isNotNull() & (status != 0), by_status).otherwise(by_type).alias(name))
    said = [("rate limit", "api_rate_limit", "yes"), ("timeout", "network_timeout", "yes"), ("dns", "network_dns", "yes"), ("ssl", "network_ssl", "no"), ("certificate", "network_ssl", "no")]
    kind = chain(said, lambda r: low.contains(r[0]), 1, cols[0])
    retry = chain(said, lambda r: low.contains(r[0]), 2, cols[2])
    return F.struct(kind.alias("error_type"), cols[1].alias("severity"), retry.alias("retryable"))


# --- versions and files


def parse_version(text: Column) -> Column:
    """`vM.m.p` to struct(major, minor, patch), which sorts as versions do; null where it is none."""
    part = lambda k: F.regexp_extract(text, r"^v?(\d+)\.(\d+)\.(\d+)$", k).try_cast("int")
    return F.when(part(1).isNotNull(), F.struct(part(1).alias("major"), part(2).alias("minor"), part(3).alias("patch")))


def bump(version: Column, kind: Column) -> Column:
    major, minor, patch = version["major"], version["minor"], version["patch"]
    zero = F.lit(0)
    return F.struct(
        (major + F.when(kind == "major", 1).otherwise(0)).alias("major"),
        F.when(kind == "major", zero).when(kind == "minor", minor + 1).otherwise(minor).alias("minor"),
        F.when(kind.isin("major", "minor"), zero).otherwise(patch + 1).alias("patch"),
    )


def version_text(version: Column) -> Column:
    return F.concat(F.lit("v"), F.concat_ws(".", version["major"].cast("string"), version["minor"].cast("string"), version["patch"].cast("string")))


def suggest_bump(added: Column, removed: Column) -> Column:
    return F.when(removed > 0, "major").when(added > 0, "minor").otherwise("patch")


def file_type(key: Column) -> Column:
    k = F.lower(key)
    # Suffix and type.
    out = F
    for suffix, name in ((".npz", "episode_npz"), (".mp4", "video_mp4"), (".json", "manifest_json"), (".parquet", "parquet"), (".h5", "hdf5"), (".hdf5", "hdf5")):
        out = out.when(k.endswith(suffix), name)
    return out.otherwise("unknown")


def compression_ratio(original: Column, size: Column) -> Column:
    return F.when((size > 0) & original.isNotNull(), original / size)


def should_compress(key: Column, size: Column, min_bytes: int = 1024) -> Column:
    # Suffixes of files that are compressed already.
    done = [".gz", ".zip", ".7z", ".lz4", ".zst", ".mp4", ".mp3", ".jpg", ".jpeg", ".png", ".webp"]
    return ~any_of([F.lower(key).endswith(s) for s in done]) & (size >= min_bytes)


# --- cost

# US dollars for a GiB and month by provider and class; for 1000 requests; for a GiB sent out.
RATES = {
    "s3": {"STANDARD": 0.025, "INTELLIGENT_TIERING": 0.023, "STANDARD_IA": 0.0138, "GLACIER": 0.004, "DEEP_ARCHIVE": 0.00099},
    "gcs": {"STANDARD": 0.023, "NEARLINE": 0.013, "COLDLINE": 0.006, "ARCHIVE": 0.0025},
}
PUT_1000, GET_1000, OUT_GIB = 0.005, 0.0004, 0.09
GIB = 1024.0**3


def storage_rate(storage_class: Column, provider: str = "s3") -> Column:
    out = None
    for name, rate in RATES[provider].items():
        out = (F if out is None else out).when(storage_class == name, rate)
    return out.otherwise(RATES["s3"]["STANDARD"])


def storage_cost(size: Column, storage_class: Column, months: Column | int = 1, provider: str = "s3") -> Column:
    return F.bround(size / GIB * storage_rate(storage_class, provider) * months, 4)


def cost_estimate(size: Column, storage_class: Column, puts: Column, gets: Column, out_bytes: Column, months: Column | int = 1, provider: str = "s3") -> Column:
    stored = size / GIB * storage_rate(storage_class, provider) * months
    asked = puts / 1000 * PUT_1000 + gets / 1000 * GET_1000
    sent = out_bytes / GIB * OUT_GIB
    return F.struct(F.bround(stored, 4).alias("storage_cost"), F.bround(asked, 4).alias("request_cost"), F.bround(sent, 4).alias("transfer_cost"), F.bround(stored + asked + sent, 4).alias("total_cost"))


def recommended_class(pattern: Column, retention_days: Column, provider: str = "s3") -> Column:
    cold = {"s3": F.when(retention_days < 180, "STANDARD_IA").otherwise("GLACIER"), "gcs": F.lit("COLDLINE")}[provider]
    warm, archive = {"s3": ("INTELLIGENT_TIERING", "DEEP_ARCHIVE"), "gcs": ("NEARLINE", "ARCHIVE")}[provider]
    return F.when(pattern == "hot", "STANDARD").when(pattern == "warm", warm).when(pattern == "cold", cold).otherwise(archive)


def lifecycle_class(age_days: Column, hot: int = 30, warm: int = 90, cold: int = 365, delete: int | None = None, provider: str = "s3") -> Column:
    names = {"s3": ("INTELLIGENT_TIERING", "STANDARD_IA", "GLACIER"), "gcs": ("NEARLINE", "COLDLINE", "ARCHIVE")}[provider]
    first = F.when(age_days >= delete, "DELETE") if delete is not None else F
    return first.when(age_days >= cold, names[2]).when(age_days >= warm, names[1]).when(age_days >= hot, names[0]).otherwise("STANDARD")


# --- monitoring


def kpi_status(kind: Column, value: Column, warning: Column, critical: Column) -> Column:
    """High is bad for error rate, latency and cost, low is bad for the others; ok without a critical threshold."""
    warn_set = warning.isNotNull() & (warning != 0)
    high = F.when(value >= critical, "critical").when(warn_set & (value >= warning), "warning").otherwise("ok")
    low = F.when(value <= critical, "critical").when(warn_set & (value <= warning), "warning").otherwise("ok")
    return F.when(critical.isNull(), "ok").when(kind.isin("error_rate", "latency", "cost"), high).otherwise(low)


def backoff_seconds(attempt: Column, base: float = 1.0, most: float = 60.0) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(most))


def micros(at: Column | str) -> Column:
    """Microseconds since 1970, of timestamps with or without a zone."""
    return F.unix_micros((F.col(at) if isinstance(at, str) else at).cast("timestamp"))


def duration_ms(started: Column, completed: Column, now: Column) -> Column:
    return F.when(started.isNotNull(), F.floor(micros(F.coalesce(completed, now)) / 1000) - F.floor(micros(started) / 1000))


def bbox_measures(bbox: Column, width: Column, height: Column) -> Column:
    """Of [x1, y1, x2, y2]: centre, area, and the box as fractions of the image."""
    x1, y1, x2, y2 = (bbox[i] for i in range(4))
    return F.struct(((x1 + x2) / 2).alias("cx"), ((y1 + y2) / 2).alias("cy"), ((x2 - x1) * (y2 - y1)).alias("area"), F.array(x1 / width, y1 / height, x2 / width, y2 / height).alias("normalized"))


def size_estimate(formats: Column) -> Column:
    """The first known size among formats with filesize and filesize_approx."""
    known = F.filter(F.transform(formats, lambda f: F.coalesce(f["filesize"], f["filesize_approx"])), lambda s: s.isNotNull())
    return F.get(known, F.lit(0))


def ratio(num: Column, den: Column, empty: float = 0.0, scale: float = 1.0) -> Column:
    return F.when(den > 0, num * scale / den).otherwise(empty)
