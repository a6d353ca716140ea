"""Scalar column builders: names, urls, answers of models."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_alias(x: Column) -> Column:
    """Lower case, underscores and dashes as blanks, single blanks."""
    return F.trim(F.regexp_replace(F.translate(F.lower(x), "_-", "  "), r"\s+", " "))


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


# Hosts of the video site, the letters of its ids, and an id anywhere in a url.
SHORT_HOSTS = ("youtu.be", "www.youtu.be")
VIDEO_HOSTS = ("youtube.com", "www.youtube.com", "m.youtube.com", "youtu.be", "www.youtu.be")
ID = "[a-zA-Z0-9_-]{11}"
ID_ANYWHERE = f"(?:v=|/)({ID})(?:[?&/]|$)"
# A model's thoughts, letters that a file name can't hold, and a score in a text.
THOUGHTS = r"(?is)<think>.*?</think>"
NOT_IN_NAMES = r'[<>:"/\\|?*]'
SCORE = r"\"?(?:bbox_)?score\"?\s*[:=]\s*[\"']?([\d.]+)"


def _found(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def video_id(url: Column) -> Column:
    """The id in a watch, short, embed, v or shorts url, else the first eleven id letters that follow a slash or v=."""
    short = F.when(host(url).isin(*SHORT_HOSTS), F.regexp_extract(path(url), "^/+([^/]*)", 1))
    watch = F.when(path(url) == "/watch", _found(F.regexp_extract(url, r"\?(?:[^#]*&)?v=([^&#]+)", 1)))
    inner = _found(F.regexp_extract(path(url), "^/(?:embed|v|shorts)/([^/]*)", 1))
    anywhere = _found(F.regexp_extract(url, ID_ANYWHERE, 1))
    return F.when(host(url).isin(*SHORT_HOSTS), short).otherwise(F.coalesce(F.when(host(url).isin(*VIDEO_HOSTS), F.coalesce(watch, inner)), anywhere))


def url_problem(url: Column) -> Column:
    """Why a url is not one of a video, or null."""
    scheme = F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    return (
        F.when(F.coalesce(url, F.lit("")) == "", "empty")
        .when(~F.lower(scheme).isin("http", "https"), "scheme")
        .when(~host(url).isin(*VIDEO_HOSTS), "domain")
        .when(F.coalesce(video_id(url), F.lit("")) == "", "no id")
        .when(~video_id(url).rlike(f"^{ID}$"), "bad id")
    )


def class_list_ok(names: Column, longest: int = 500) -> Column:
    return F.coalesce((F.size(names) > 0) & F.forall(names, lambda n: n.isNotNull() & (F.trim(n) != "") & (F.length(n) <= longest)), F.lit(False))


def safe_name(x: Column, longest: int = 100) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(x, NOT_IN_NAMES, "_"), r"\s+", "_"), "_+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    cut = F.when(F.length(s) > longest, F.regexp_replace(F.substring(s, 1, longest), "_+$", "")).otherwise(s)
    return F.coalesce(_found(cut), F.lit("unnamed"))


def stem(x: Column) -> Column:
    """File name without folders and its last ending."""
    return F.regexp_replace(F.regexp_extract(x, "([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def yolo_line(cls: Column, *values: Column, digits: int = 6) -> Column:
    return F.format_string("%d " + " ".join([f"%.{digits}f"] * len(values)), cls, *values)


def yes_no(answer: Column) -> Column:
    """True for an answer with yes and without no, false with no, else null; by substrings."""
    a = F.lower(F.regexp_replace(answer, THOUGHTS, ""))
    return F.when(a.contains("yes") & ~a.contains("no"), True).when(a.contains("no"), False)


def plain_json(text: Column) -> Column:
    """The JSON of a model's answer as text: without thoughts, fences and trailing commas; parse it with try_parse_json."""
    t = F.regexp_replace(text, THOUGHTS, "")
    fenced = _found(F.regexp_extract(t, r"(?s)```(?:json)?\s*(.*?)\s*```", 1))
    return F.regexp_replace(F.trim(F.coalesce(fenced, t)), r",\s*([}\]])", "$1")


def box_list_json(text: Column) -> Column:
    """Text of the JSON list of an answer: a lone object becomes a list of one, no JSON an empty list."""
    t = F.trim(F.regexp_replace(F.regexp_replace(text, r"```json\s*", ""), r"```\s*", ""))
    inner = _found(F.regexp_extract(t, r"(?s)(\[.*\])", 1))
    one = _found(F.regexp_extract(t, r"(?s)(\{.*\})", 1))
    ok = lambda c: F.try_parse_json(c).isNotNull() & F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))).isNotNull()  # noqa: E731  nothing follows it
    listed = lambda c: F.when(c.startswith("["), c).otherwise(F.concat(F.lit("["), c, F.lit("]")))
    return F.when(ok(t), listed(t)).when(ok(inner), inner).when(ok(one), listed(one)).otherwise("[]")


def rating_score(text: Column) -> Column:
    """bbox_score (or score) of a rating: from its JSON, Python literals mended, else by pattern; cut to 0..1, -1 if none."""
    t = F.regexp_replace(F.regexp_replace(text, THOUGHTS, ""), r"```json\s*|```\s*", "")
    body = _found(F.regexp_extract(t, r"(?s)(\{.*\})", 1))
    mended = F.replace(F.replace(F.replace(F.translate(body, "'", '"'), F.lit("True"), F.lit("true")), F.lit("False"), F.lit("false")), F.lit("None"), F.lit("null"))
    of = lambda c: F.coalesce(F.get_json_object(c, "$.bbox_score"), F.get_json_object(c, "$.score")).try_cast("double")
    parsed = F.when(F.try_parse_json(body).isNotNull(), of(body)).when(F.try_parse_json(mended).isNotNull(), of(mended))
    by_text = _found(F.regexp_extract(t, SCORE, 1)).try_cast("double")
    score = F.coalesce(parsed, by_text)
    return F.when(score >= 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))).otherwise(-1.0)


def first_balanced(text: str | None) -> str | None:
    """The first balanced {...}, else [...], of a text: what no regular expression can find."""
    text = text or ""
    for opened, closed in ("{}", "[]"):
        start, depth = text.find(opened), 0
        for i in range(max(start, 0), len(text) if start >= 0 else 0):
            depth += (text[i] == opened) - (text[i] == closed)
            if depth == 0:
                return text[start : i + 1]
    return None


def balanced_json(text: Column) -> Column:
    """``plain_json``, or its first balanced part where the whole does not parse; null if neither does."""

    @F.pandas_udf("string")
    def inner(texts: pd.Series) -> pd.Series:
        return texts.map(first_balanced)

    p = plain_json(text)
    part = inner(p)
    return F.when(F.try_parse_json(p).isNotNull(), p).when(F.try_parse_json(part).isNotNull(), part)


def search_url(term: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/results?search_query="), F.url_encode(term))


def api_params(term: Column, n: Column) -> Column:
    return F.create_map(F.lit("q"), term, F.lit("type"), F.lit("video"), F.lit("maxResults"), F.least(n, F.lit(50)).cast("string"))


def live_query(source: Column, how_to: Column) -> Column:
    """A quoted part of the hint of more than five letters, else what follows ``youtube:``."""
    parts = F.filter(F.split(how_to, "'"), lambda x, i: (i % 2 == 1) & (F.length(F.trim(x)) > 5))
    after = F.when(F.lower(source).startswith("youtube:"), F.trim(F.regexp_replace(F.trim(F.regexp_extract(source, "(?s)^[^:]*:(.*)$", 1)), "^['\"]+|['\"]+$", "")))
    return F.coalesce(F.trim(F.get(parts, F.lit(0))), after)


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit(f"{{{name}}}"), value)
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def blocked_tag(tags: Column, description: Column, patterns: Column) -> Column:
    """The first pattern that is part of a tag, or of a # word of the description, or null."""
    words = F.regexp_extract_all(F.lower(F.coalesce(description, F.lit(""))), F.lit(r"(#\w+)"), F.lit(1))
    every = F.concat(F.transform(F.coalesce(tags, F.array().cast("array<string>")), F.lower), words)
    hits = F.flatten(F.transform(every, lambda t: F.filter(patterns, lambda p: t.contains(p))))
    return F.get(hits, F.lit(0))


def confusion_id(expected: Column, detected: Column, n: int) -> Column:
    """Dense id: n right ones, n (n - 1) swaps by row, n others; an unknown expectation gives 2 n."""
    right = F.when(expected == detected, expected)
    swap = F.lit(n) + expected * (n - 1) + detected - (detected > expected).cast("int")
    return F.when((expected < 0) | (expected >= n), F.lit(2 * n)).otherwise(F.coalesce(right, F.when((detected >= 0) & (detected < n), swap).otherwise(n + n * (n - 1) + expected)))
