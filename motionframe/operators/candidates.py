"""Candidate operators: content filters, parsing of search results, relevance and technical scores, keyword work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.functions.scalar import any_of, rational

# Terms of the crawl's content filter; a text must have one of the first and none of the second.
RELEVANT = [
    "robot", "robotic", "arm", "gripper", "manipulator", "pick", "place", "grasping", "cobot", "industrial",
    "fanuc", "abb", "kuka", "ur5", "ur10", "ur3", "automation", "manufacturing", "assembly",
    "로봇", "로봇팔", "그리퍼", "매니퓰레이터",
]
REJECTED = [
    "animation", "cartoon", "cgi", "3d render", "toy", "lego", "surgery", "medical", "prosthetic", "game",
    "minecraft", "roblox", "fortnite", "unboxing", "review", "price", "how much",
]
# Terms of the download's stricter filter.
STRICT_REQUIRED = ["robot arm", "robotic arm", "robot gripper", "pick and place", "pick & place", "grasping", "manipulation", "object manipulation", "assembly", "bin picking"]
STRICT_REJECTED = ["animation", "simulation", "cgi", "3d render", "toy", "lego", "surgery", "medical"]
# Terms that relevance is measured by.
TARGETS = ["robot", "assembly", "manipulation", "grasping", "pick", "place", "tutorial", "demonstration"]
URL_COLUMNS = ["url", "video_url", "video", "link"]


def has_any(text: Column, terms: list[str]) -> Column:
    """Substring tests, as 'arm' is in 'farm'."""
    return any_of([text.contains(t) for t in terms])


def joined(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *(F.coalesce(p, F.lit("")) for p in parts)))


def passes_content(title: Column, description: Column, required: list[str] = RELEVANT, rejected: list[str] = REJECTED) -> Column:
    text = joined(title, description)
    return ~has_any(text, rejected) & has_any(text, required)


def passes_strict(*parts: Column) -> Column:
    text = joined(*parts)
    return ~has_any(text, STRICT_REJECTED) & has_any(text, STRICT_REQUIRED)


def not_rejected(title: Column, description: Column, tags: Column) -> Column:
    """Only the rejected terms count here."""
    return ~has_any(joined(title, description, F.array_join(tags, " ")), STRICT_REJECTED)


def passes_duration(seconds: Column, least: int = 30, most: int = 1200) -> Column:
    return seconds.isNull() | seconds.between(least, most)


def passes_constraints(info: DataFrame) -> DataFrame:
    """With the column passes: duration, and the best height, fps and bit rate of the formats that have video."""
    video = F.filter("formats", lambda f: f["vcodec"].isNotNull() & (f["vcodec"] != "none"))
    best = lambda c: F.greatest(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.coalesce(F.array_max(F.transform(video, lambda f: f[c].cast("double"))), F.lit(0.0)))
    ok = F.coalesce("duration", F.lit(0)).between(60, 300) & (best("height") >= 480) & (best("fps") >= 24)
    ok &= (best("tbr") == 0) | (best("tbr") >= 2000)
    return info.withColumn("passes", ok & passes_strict(F.col("title"), F.col("description")))


def keep_video(seconds: Column, title: Column, description: Column, tags: Column) -> Column:
    return F.coalesce(seconds, F.lit(0)).between(10, 300) & passes_strict(title, description, F.array_join(tags, " "))


def url_column(columns: list[str]) -> str | None:
    lower = [c.lower() for c in columns]
    return next((columns[lower.index(c)] for c in URL_COLUMNS if c in lower), columns[0] if columns else None)


def first_seen(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key, by order; ties are broken by the whole row. Combines before the shuffle."""
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min(F.struct(*order, *(F.col(c).alias(f"__{c}") for c in rest))).alias("r"))
    return first.select(*(F.col(f"r.__{c}").alias(c) if c != key else F.col(key) for c in df.columns))


def crawl_flags(found: DataFrame, key: str = "video_id", order: list[str] = ["discovered_at", "platform", "keyword"]) -> DataFrame:
    """Each row found with its outcome: duplicate, filtered or accepted; duplicates are told before filters apply."""
    dup = F.row_number().over(Window.partitionBy(key).orderBy(*order)) > 1
    rows = found.withColumn("__filtered", _filtered())  # before the shuffle, which titles then need not take part in
    return rows.withColumn("outcome", F.when(dup, "duplicate").when(F.col("__filtered"), "filtered").otherwise("accepted")).drop("__filtered")


def _filtered() -> Column:
    ok = passes_content(F.col("title"), F.col("description")) & passes_duration(F.col("duration_sec"))
    return F.coalesce(~ok, F.lit(False))


def crawl_funnel(found: DataFrame, key: str = "video_id", order: list[str] = ["discovered_at", "platform", "keyword"]) -> DataFrame:
    """How many rows were found, duplicates, filtered and accepted: in total, by platform and by keyword.

    As crawl_flags tells it, but counted before the shuffle: of each key, one row a platform and keyword is shuffled, however
    many rows have that key, and no titles are. Rows that are equal in order count as filtered only if all of them are.
    """
    at = F.struct(*order, _filtered().alias("__filtered"))
    per = found.select(key, "platform", "keyword", at.alias("__at")).groupBy(key, "platform", "keyword").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__at"))
    place = F.struct("__at", "platform", "keyword")
    per = per.withColumn("__first", place.eqNullSafe(F.min(place).over(Window.partitionBy(key))).cast("int"))
    filtered = F.when(F.col("__at.__filtered"), F.col("__first")).otherwise(0)
    total = lambda v: F.sum(v).cast("long")
    sets = per.groupingSets([["platform"], ["keyword"], []], "platform", "keyword")
    counts = {"found": F.col("__n"), "duplicates": F.col("__n") - F.col("__first"), "filtered": filtered, "accepted": F.col("__first") - filtered}
    return sets.agg(F.grouping_id().alias("g"), *(total(v).alias(c) for c, v in counts.items()))


def scraped_urls(pages: DataFrame, pattern: str, limit: int, key: str = "page_id", html: str = "html") -> DataFrame:
    """The first `limit` distinct URLs in each page, in order, without a slash at their end."""
    urls = F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), lambda u: F.regexp_replace(u, "/+$", ""))
    return pages.select(key, F.posexplode(F.slice(F.array_distinct(urls), 1, limit)).alias("position", "url"))


SEARCH_SCHEMA = "contents array<struct<videoRenderer:struct<videoId:string,title:struct<runs:array<struct<text:string>>>,ownerText:struct<runs:array<struct<text:string>>>,lengthText:struct<simpleText:string>,viewCountText:struct<simpleText:string>,thumbnail:struct<thumbnails:array<struct<url:string>>>>>>"


def search_results(json: DataFrame, column: str = "json") -> DataFrame:
    """Rows of videos from nested search results: title of all runs, first owner, last thumbnail."""
    items = json.select(F.explode(F.from_json(column, SEARCH_SCHEMA)["contents"]).alias("item")).select(F.col("item.videoRenderer").alias("v")).where("v.videoId is not null")
    return items.select(
        F.col("v.videoId").alias("video_id"),
        F.array_join(F.col("v.title.runs.text"), "").alias("title"),
        F.get(F.col("v.ownerText.runs.text"), F.lit(0)).alias("channel_name"),
        F.col("v.lengthText.simpleText").alias("duration_text"),
        F.col("v.viewCountText.simpleText").alias("view_text"),
        F.try_element_at(F.col("v.thumbnail.thumbnails.url"), F.lit(-1)).alias("thumbnail_url"),
    )


def embedded_json(html: Column, name: str) -> Column:
    """The JSON object that a page assigns to a variable, up to `;</script>`."""
    found = F.regexp_extract(html, rf"(?s){name}\s*=\s*(\{{.*?\}})\s*;\s*</script>", 1)
    return F.nullif(found, F.lit(""))


PROBE_SCHEMA = "streams array<struct<codec_type:string,codec_name:string,width:int,height:int,r_frame_rate:string>>, format struct<duration:string,bit_rate:string,size:string>"


def probe_metadata(json: Column) -> Column:
    """struct of what a media probe's JSON says about the first video and audio streams."""
    p = F.from_json(json, PROBE_SCHEMA)
    first = lambda kind: F.get(F.filter(p["streams"], lambda s: s["codec_type"] == kind), F.lit(0))
    v, a = first("video"), first("audio")
    return F.struct(v["width"].alias("width"), v["height"].alias("height"), rational(v["r_frame_rate"]).alias("fps"), v["codec_name"].alias("video_codec"), a["codec_name"].alias("audio_codec"), p["format"]["duration"].try_cast("double").alias("duration_sec"), p["format"]["bit_rate"].try_cast("bigint").alias("bitrate_bps"))


def normalized_record(videos: DataFrame) -> DataFrame:
    """The canonical columns with defaults; descriptions are cut to 500 characters."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    number = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c)
    return videos.select("video_id", text("platform"), text("url"), text("title"), F.substring(F.coalesce("description", F.lit("")), 1, 500).alias("description"), number("duration_sec"), number("view_count"), text("channel_name"))


# --- scores (Q9-Q11)


def technical_score(height: Column, fps: Column, seconds: Column, bitrate_bps: Column, strict: bool = False) -> Column:
    """struct(resolution, fps, duration, bitrate, technical, reasons)."""
    # Least and preferred height, fps, duration and bit rate.
    h0, h1, f0, f1 = (1080 if strict else 720), 1080, (30 if strict else 24), 30
    d0, dp, d1, b0, b1 = 10.0, 300.0, 1200.0, 1.0, 5.0
    clip = lambda c, lo=0.0: F.least(F.lit(1.0), F.greatest(F.lit(lo), c))
    mbps = bitrate_bps / 1e6
    r = F.when(height < h0, 0.0).when(height >= h1, 1.0).otherwise(clip((height - h0) / float(max(h1 - h0, 1))))
    f = F.when(fps < f0, 0.0).when(fps >= f1, 1.0).otherwise(clip((fps - f0) / float(max(f1 - f0, 1))))
    d = F.when((seconds < d0) | (seconds > d1), 0.0).when(seconds <= dp, clip(seconds / dp)).otherwise(clip(1.0 - (seconds - dp) / (d1 - dp) * 0.5))
    b = F.when(mbps < b0, 0.2).when(mbps >= b1, 1.0).otherwise(clip((mbps - b0) / (b1 - b0), 0.2))
    reasons = F.array_compact(F.array(F.when(height < h0, "resolution"), F.when(fps < f0, "fps"), F.when(seconds < d0, "too_short"), F.when(seconds > d1, "too_long"), F.when(mbps < b0, "bitrate")))
    return F.struct(r.alias("resolution"), f.alias("fps"), d.alias("duration"), b.alias("bitrate"), ((r + f + d + b) / 4.0).alias("technical"), reasons.alias("reasons"))


def _tagged(tags: Column, term: str) -> Column:
    return F.exists(tags, lambda x: x.contains(term))


def relevance_score(title: Column, description: Column, tags: Column, views: Column, likes: Column, targets: list[str] = TARGETS) -> Column:
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    hits = lambda text: sum((text.contains(t).cast("double") for t in targets), F.lit(0.0)) / float(len(targets))
    tag = F.coalesce(F.transform(tags, F.lower), F.array().cast("array<string>"))
    tag_hits = sum((_tagged(tag, t).cast("double") for t in targets), F.lit(0.0)) / float(len(targets))
    score = hits(low(title)) * 0.5 + tag_hits * 0.3 + hits(low(description)) * 0.2
    bonus = F.when(views > 10000, 1.1).otherwise(1.0) * F.when(likes > 100, 1.05).otherwise(1.0)
    return F.least(F.lit(1.0), score * bonus)


def overall_score(technical: Column, relevance: Column, reasons: Column, strict: bool = False) -> Column:
    """struct(overall, level, should_process)."""
    overall = technical * 0.6 + relevance * 0.4
    level = F.when((F.size(reasons) > 0) | (overall < 0.3), "rejected").when(overall >= 0.85, "excellent").when(overall >= 0.7, "good").when(overall >= (0.6 if strict else 0.5), "acceptable").otherwise("poor")
    return F.struct(overall.alias("overall"), level.alias("level"), (level != "rejected").alias("should_process"))


def level_distribution(scored: DataFrame) -> DataFrame:
    """Counts of each level with the share of all that is not rejected."""
    per = scored.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # five rows
    return per.withColumn("acceptance_rate", F.sum(F.when(F.col("level") != "rejected", F.col("n")).otherwise(0)).over(Window.partitionBy()) / total)


# --- keywords


def title_terms(titles: DataFrame, column: str, exclude: list[str] = [], least: int = 2, top: int = 50) -> DataFrame:
    """The most frequent longer words of titles, without punctuation at their ends."""
    words = titles.select(F.explode(F.split(F.lower(column), r"\s+")).alias("word"))
    word = F.regexp_replace("word", r"""^[.,!?()\[\]{}"']+|[.,!?()\[\]{}"']+$""", "")
    counts = words.select(word.alias("word")).where((F.length("word") > 3) & ~F.col("word").isin(exclude)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least).orderBy(F.col("n").desc(), "word").limit(top)


# Terms that suggestions are not made of.
ROBOT_TERMS = ["robot", "arm", "robotic", "gripper", "manipulator"]


def suggested_keywords(terms: DataFrame, limit: int = 20) -> DataFrame:
    rows = terms.where(~F.col("word").isin(ROBOT_TERMS)).select("word", "n", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.concat(F.lit("robot arm "), "word").alias("keyword")), F.struct(F.lit(1).alias("k"), F.concat(F.lit("robotic "), "word").alias("keyword")))).alias("s"))
    return rows.orderBy(F.col("n").desc(), "word", "s.k").limit(limit).select("s.keyword")


def top_n(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.col(by).desc(), tie).limit(n)


def batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Rows numbered into batches of `size` in order: ranges are counted first, so no task numbers all rows."""
    sorted_ = df.orderBy(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    sorted_ = sorted_.persist()
    counts = sorted_.groupBy("__part").count()
    starts = counts.select("__part", (F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("__start"))
    place = F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1)
    return sorted_.join(F.broadcast(starts), "__part").withColumn("batch", F.floor(place / size)).drop("__part", "__at", "__start")  # one row for each partition


def flat_keywords(keywords: DataFrame, limit: int) -> DataFrame:
    """Keywords by priority, the first of those that are equal but for case and blanks."""
    key = F.lower(F.trim("keyword"))
    first = keywords.groupBy(key.alias("__k")).agg(F.max(F.struct("priority", F.col("keyword").alias("keyword"))).alias("r"))
    return first.select("r.keyword", "r.priority").orderBy(F.col("priority").desc(), "keyword").limit(limit)


def quota(rows: DataFrame, total: int, n_groups: int, by: list[str], order: list[str]) -> DataFrame:
    """At most max(1, total // n_groups) rows of each group, and total rows in all."""
    w = Window.partitionBy(*by).orderBy(*order)
    each = max(1, total // max(1, n_groups))
    return rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= each).orderBy(*by, "__n").limit(total).drop("__n")


def keyword_combinations(bases: DataFrame, modifiers: DataFrame) -> DataFrame:
    """Every base with every modifier; two word lists, not data."""
    pairs = F.broadcast(bases).crossJoin(modifiers)
    return pairs.select(F.concat_ws(" ", "base", "modifier").alias("keyword"))
