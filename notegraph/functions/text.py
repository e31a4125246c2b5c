"""Text expressions over note columns. All are built-in expressions but those that say they need Python."""

from __future__ import annotations

import difflib
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = " \t\n\r\x0b\x0c"

# fixed values: patterns, words and weights that decide results
#: A header block at the very start: dashes, anything, dashes.
HEADER = r"(?s)\A---[ \t]*\n.*?\n---[ \t]*(?:\n|\z)"
STRICT_HEADER = r"(?s)\A---\n.*?\n---(?:\n|\z)"
#: Marks that do not count towards a body's length, and the least length of a body that is worth keeping.
MARKS, TINY = r"[*_#>\[\]()\\\n\t]", 30
#: Bodies that are just an embed.
PDF_BODY = r"(?i)\A!\[[^\]]*\.pdf[^\]]*\]\([^)]+\)\z"
PICTURE_BODY = r"\A!\[[^\]]*\]\([^)]+\)\z"
URL_BODY = r"\A<?https?://\S+>?\z"
AUDIO_BODY = r"(?i)\A\[[^\]]*\d{8,}[^\]]*\.(?:m4a|mp3|wav)\]\([^)]+\)\z"
#: Runs of capitalised words, and calendar words that make such a run no name.
NAMES = r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)\b"
CALENDAR = (
    "Monday Tuesday Wednesday Thursday Friday Saturday Sunday "
    "January February March April May June July August September October November December"
).split()
#: A claim: up to a closing mark, with a citation behind it, before white space; or what is left of the line.
CLAIM, LINE_ENDS = r"(?U)(.*?[.!?](?:\s*\(src:[^)]*\))?(?=\s|$)|.+$)", "\r\n|[\n\x0B\x0C\r\x1C-\x1E\x85\u2028\u2029]"
#: A cluster's score: weights of anchor share, cohesion and size; the floor of each; the size that counts in full.
WEIGHTS, FACTOR_FLOOR, SIZE_TARGET = (0.4, 0.35, 0.25), 0.1, 6
#: Days in which evidence halves.
HALF_LIFE = 30.0
#: Confidence bands.
HIGH, MEDIUM = 0.8, 0.5


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def one_line(c: Column) -> Column:
    """White space runs to single spaces, trimmed."""
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\x0B\f]+", " "))


def normalise_title(c: Column) -> Column:
    return F.lower(one_line(c))


def strip_header(c: Column, strict: bool = False) -> Column:
    """The text behind its header block; the whole text where there is none."""
    return F.regexp_replace(c, STRICT_HEADER if strict else HEADER, "")


def header_of(c: Column) -> Column:
    """The inside of the header block; empty where there is none."""
    return F.regexp_extract(c, r"(?s)\A---[ \t]*\n(.*?)\n---[ \t]*(?:\n|\z)", 1)


def header_field(c: Column, name: str) -> Column:
    """A one-line ``name: value`` of the header block, without quotes around the value; null if absent."""
    found = strip(F.regexp_extract(header_of(c), rf"(?m)^{name}:[ \t]*(.*)$", 1))
    bare = F.regexp_replace(found, r"""^(["'])(.*)\1$""", "$2")
    return F.when(F.length(bare) > 0, bare)


def strip_title_field(c: Column) -> Column:
    """Drops ``title:`` lines inside the header block only."""
    block = F.regexp_extract(c, r"(?s)\A(---[ \t]*\n.*?\n---[ \t]*(?:\n|\z))", 1)
    return F.concat(F.regexp_replace(block, r"(?m)^title:.*\n", ""), F.substring(c, F.length(block) + 1, F.length(c)))


def strip_matching_h1(c: Column, stem: Column) -> Column:
    """Drops a leading ``# X`` and one blank line after it where X is the stem, with or without a leading date."""
    head = strip(F.regexp_extract(c, r"\A# ([^\n]*)(?:\n|\z)", 1))
    undated = F.regexp_replace(stem, r"^\d{4}-\d{2}-\d{2}[ _-]*", "")
    hit = (F.length(head) > 0) & ((head == stem) | (head == undated))
    return F.when(hit, F.regexp_replace(c, r"\A# [^\n]*(?:\n|\z)\n?", "")).otherwise(c)


def tiny_body(c: Column, least: int = TINY) -> Column:
    """Fewer than ``least`` characters once marks of Markdown, tabs and line ends are gone."""
    return F.length(strip(F.regexp_replace(c, MARKS, ""))) < least


def body_shape(c: Column) -> Column:
    """``image``, ``pdf``, ``url`` or ``audio`` for a body that is just that; else null."""
    t = strip(c)
    return F.when(t.rlike(PDF_BODY), "pdf").when(t.rlike(PICTURE_BODY), "image").when(t.rlike(URL_BODY), "url").when(t.rlike(AUDIO_BODY), "audio")


def excerpt(c: Column, n: int = 400) -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


def sentences(c: Column) -> Column:
    """Sentences with one closing mark each, white space collapsed, empties dropped."""
    found = F.regexp_extract_all(one_line(c), F.lit(r"([^.!?]+(?:[.!?]|$))"), F.lit(1))
    return F.filter(F.transform(found, lambda s: F.trim(s)), lambda s: s != "")


def tokens(c: Column) -> Column:
    """Distinct runs of a-z and 0-9 of at least three characters, in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]{3,})"), F.lit(1)))


def people(c: Column) -> Column:
    """Runs of two or more capitalised words, none of them a calendar word, each once in order of appearance."""
    found = F.regexp_extract_all(c, F.lit(NAMES), F.lit(1))
    dated = rf"\b(?:{'|'.join(CALENDAR)})\b"
    return F.array_distinct(F.filter(found, lambda p: ~p.rlike(dated)))


def tags(lowered: Column, patterns: dict[str, list[str]]) -> Column:
    """Each tag of which some pattern is contained, in the order of the table."""
    if not patterns:
        return F.array().cast("array<string>")
    hits = [F.when(_any([lowered.contains(p) for p in ps]), F.lit(tag)) for tag, ps in patterns.items()]
    return F.array_compact(F.array(*hits))


def _any(cs: list[Column]) -> Column:
    out = cs[0]
    for c in cs[1:]:
        out = out | c
    return out


def keyword_hits(lowered: Column, table: dict[str, list[str]]) -> Column:
    """Per category the number of its keywords that are contained, each once: a map in the order of the table."""
    parts = []
    for category, words in table.items():
        total = F.lit(0)
        for w in words:
            total = total + lowered.contains(w).cast("int")
        parts += [F.lit(category), total]
    return F.create_map(*parts)


def argmax_first(scores: Column, order: list[str]) -> Column:
    """The best category, ties by the order of the table; null if none scored."""
    best = F.array_max(F.map_values(scores))
    out = F.lit(None).cast("string")
    for k in reversed(order):
        out = F.when(scores[k] == best, F.lit(k)).otherwise(out)
    return F.when(best > 0, out)


def top_share(scores: Column) -> Column:
    v = F.map_values(scores)
    total = F.aggregate(v, F.lit(0), lambda a, x: a + x)
    return F.when(total == 0, 0.0).otherwise(F.array_max(v) / total)


def keyword_weight(lowered: Column, weights: dict[str, float]) -> Column:
    total = F.lit(0.0)
    for w, x in weights.items():
        total = total + F.when(lowered.contains(w), F.lit(float(x))).otherwise(0.0)
    return total


def matched_keywords(lowered: Column, words: list[str], most: int = 6) -> Column:
    return F.slice(F.array_compact(F.array(*[F.when(lowered.contains(w), F.lit(w)) for w in words])), 1, most)


def first_rule(c: Column, rules: list[tuple[str, str]]) -> Column:
    """The label of the first (pattern, label) that is found."""
    return F.coalesce(*[F.when(c.rlike(p), F.lit(label)) for p, label in rules]) if rules else F.lit(None).cast("string")


def confidence_band(c: Column) -> Column:
    return F.when(c >= HIGH, "high").when(c >= MEDIUM, "medium").otherwise("low")


def links(c: Column) -> Column:
    """Targets of wiki links, without heading and alias."""
    return F.transform(
        F.regexp_extract_all(c, F.lit(r"\[\[([^\]\[]+)\]\]"), F.lit(1)),
        lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"[#|].*$", ""), r"\.md$", "")),
    )


def slug_of_link(c: Column) -> Column:
    """The inside of a text that is one wiki link, without alias, heading and ``.md``; null for others."""
    inner = F.regexp_extract(c, r"\A\s*\[\[([^\]\[]+)\]\]\s*\z", 1)
    bare = F.trim(F.regexp_replace(F.regexp_replace(inner, r"[#|].*$", ""), r"\.md$", ""))
    return F.when(F.length(bare) > 0, bare)


def slugify(c: Column) -> Column:
    """Lower-case ASCII words joined by dashes; other letters are reduced to their base letter (needs `fold`'s Python)."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(_ascii(c)), "'", ""), "[^a-z0-9]+", "-"), F.lit("-"))


def slugify_plain(c: Column) -> Column:
    """`slugify` for texts whose letters are ASCII already."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "'", ""), "[^a-z0-9]+", "-"), F.lit("-"))


@F.pandas_udf(T.StringType())
def _ascii(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


APOSTROPHES = str.maketrans({"’": "'", "‘": "'", "‛": "'", "`": "'"})


def folded(x: str) -> str:
    """Typographic apostrophes to plain ones, compatibility decomposition, case folding."""
    if x.isascii():
        return x.replace("`", "'").lower()
    return unicodedata.normalize("NFKD", x.translate(APOSTROPHES)).casefold()


@F.pandas_udf(T.StringType())
def fold(s: pd.Series) -> pd.Series:
    """`folded` as an expression. Python: Spark cannot decompose."""
    return s.map(lambda x: None if x is None else folded(x))


@F.pandas_udf(T.StringType())
def casefold(s: pd.Series) -> pd.Series:
    """Case folding alone. Python: Spark's lower case is another."""
    return s.map(lambda x: None if x is None else x.casefold())


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio of two texts, rounded to six places. Python: the measure is the standard library's."""
    ratio = lambda x, y: None if x is None or y is None else round(difflib.SequenceMatcher(None, x, y).ratio(), 6)
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def similarity_bound(a: Column, b: Column) -> Column:
    """No matching-block ratio is larger, whatever the texts say: the shorter one matches as a whole at most."""
    n, m = F.length(a), F.length(b)
    return F.when(n + m == 0, 1.0).otherwise(F.round(2 * F.least(n, m) / (n + m), 6))


@F.pandas_udf(T.StringType())
def extract_json(s: pd.Series) -> pd.Series:
    """The JSON object of a fenced block, else the first balanced object of a text; null without one. Python."""
    fence = re.compile(r"```(?:json)?\s*(\{.*?\})\s*```", re.S)
    decoder = json.JSONDecoder()

    def one(x):
        if x is None:
            return None
        m = fence.search(x)
        for at in [m.start(1)] if m else [i for i, ch in enumerate(x) if ch == "{"]:
            try:
                value, end = decoder.raw_decode(x, at)
            except ValueError:
                continue
            if isinstance(value, dict):
                return x[at:end]
        return None

    return s.map(one)


def cited(c: Column) -> Column:
    """All n of ``Bn`` inside ``(src: B1, B2)`` groups, in order."""
    groups = F.regexp_extract_all(c, F.lit(r"\(src:([^)]*)\)"), F.lit(1))
    return F.flatten(F.transform(groups, lambda g: F.transform(F.regexp_extract_all(g, F.lit(r"B(\d+)"), F.lit(1)), lambda n: n.cast("int"))))


def claims(c: Column) -> Column:
    """Sentences of every line, each with the citation behind its closing mark; a line's bullet stands before each."""
    lines = F.filter(F.transform(F.split(strip(c), LINE_ENDS), lambda s: F.rtrim(F.regexp_replace(s, r"(?U)\s+$", ""))), lambda x: x != "")
    bullet = lambda x: F.regexp_extract(x, r"(?U)^(\s*[-*]\s+)", 1)
    body = lambda x: F.substring(x, F.length(bullet(x)) + 1, F.length(x))
    parts = lambda x: F.regexp_extract_all(body(x), F.lit(CLAIM), F.lit(1))
    return F.flatten(F.transform(lines, lambda x: F.transform(parts(x), lambda s: F.concat(bullet(x), strip(s)))))


def verified(c: Column, n_sources: Column) -> Column:
    """Whether a claim has citations and all of them are in 1..n."""
    refs = cited(c)
    return (F.size(refs) > 0) & F.forall(refs, lambda r: (r >= 1) & (r <= n_sources))


def summary_line(c: Column) -> Column:
    """The first claim without its citations."""
    first = F.get(claims(c), F.lit(0))
    return one_line(F.regexp_replace(first, r"\s*\(src:[^)]*\)", ""))


def deep_link(vault: Column, path: Column) -> Column:
    enc = lambda x: F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))
    return F.concat(F.lit("app://open?vault="), enc(vault), F.lit("&file="), enc(path))


def md_cell(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", "n/a").otherwise(F.replace(c, F.lit("\n"), F.lit(" ")))


def md_row(*cs: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *map(md_cell, cs)), F.lit(" |"))


def replace_region(text: Column, body: Column, name: str) -> Column:
    """Puts ``body`` between the begin and end marks of ``name``; adds both at the end when absent; null when malformed."""
    begin, end = f"<!-- {name}:begin -->", f"<!-- {name}:end -->"
    at, to = F.instr(text, begin), F.instr(text, end)
    many = (F.size(F.split(text, re.escape(begin))) > 2) | (F.size(F.split(text, re.escape(end))) > 2)
    fenced = F.size(F.split(F.left(text, at), "(?m)^```")) % 2 == 0
    block = F.concat(F.lit(begin + "\n"), body, F.lit("\n" + end))
    after = F.substring(text, to + len(end), F.length(text))
    return (
        F.when((at == 0) & (to == 0), F.concat(text, F.when(text.endswith("\n") | (text == ""), "").otherwise("\n"), block, F.lit("\n")))
        .when(many | (at == 0) | (to < at) | fenced, F.lit(None))
        .otherwise(F.concat(F.left(text, at - 1), block, after))
    )


def guid_of(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"([0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})", 1))
    return F.when(found != "", found)


def markdown_links(c: Column) -> Column:
    """``[{label, url}]`` of Markdown links to http addresses."""
    label = F.regexp_extract_all(c, F.lit(r"\[([^\]]*)\]\((https?://[^)\s]+)\)"), F.lit(1))
    url = F.regexp_extract_all(c, F.lit(r"\[([^\]]*)\]\((https?://[^)\s]+)\)"), F.lit(2))
    return F.arrays_zip(label.alias("label"), url.alias("url"))


def audio_embeds(c: Column) -> Column:
    """Markdown links to audio files as embeds; those that are embeds already stay."""
    return F.regexp_replace(c, r"(?i)(^|[^!])\[[^\]]*\]\(([^)]+?\.(?:m4a|mp3|wav))\)", r"$1![[$2]]")


def note_time(*candidates: Column) -> Column:
    """The first candidate text that is a date or a time."""
    return F.coalesce(*map(F.try_to_timestamp, candidates))


def iso_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def first_words(c: Column, n: int) -> Column:
    """The first n parts between single spaces."""
    return F.array_join(F.slice(F.split(c, " "), 1, n), " ")


# --- scores


def saturating_size(n: Column, target: int = SIZE_TARGET) -> Column:
    return F.when(n <= 1, 0.0).otherwise(F.least(F.lit(1.0), F.ln(n) / F.ln(F.lit(max(target, 2)))))


def smooth(s: Column, floor: float = FACTOR_FLOOR) -> Column:
    return floor + (1.0 - floor) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), s))


def cluster_confidence(share: Column, cohesion: Column, n: Column, weights: tuple[float, float, float] = WEIGHTS, floor: float = FACTOR_FLOOR, target: int = SIZE_TARGET) -> Column:
    """Weighted geometric mean of anchor share, cohesion and size."""
    a, b, c = weights
    return F.pow(smooth(share, floor), F.lit(a)) * F.pow(smooth(cohesion, floor), F.lit(b)) * F.pow(smooth(saturating_size(n, target), floor), F.lit(c))


def decay(evidence: Column, days: Column, half_life: float = HALF_LIFE) -> Column:
    """Evidence after so many days; unknown days or no half-life leave it as it is."""
    if half_life <= 0:
        return evidence
    return evidence * F.pow(F.lit(0.5), F.greatest(F.coalesce(days, F.lit(0.0)), F.lit(0.0)) / half_life)


def topic_confidence(n: Column, quality: Column) -> Column:
    q = F.greatest(F.lit(0.0), F.least(F.lit(1.0), quality))
    return F.when(n <= 0, 0.0).otherwise(F.least(n / 3.0, F.lit(1.0)) * 0.5 + 0.5 * q)


def cluster_signature(members: Column, dominant: Column) -> Column:
    return F.concat(F.lit("sig:"), F.left(F.sha2(F.concat_ws("\0", F.array_sort(members), dominant), 256), F.lit(16)))


def anchor_label(anchor: Column) -> Column:
    return F.initcap(F.trim(F.translate(F.regexp_replace(anchor, r"^[a-z]+:", ""), "-_", "  ")))
