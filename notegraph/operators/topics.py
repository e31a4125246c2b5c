"""The topic dimension, generated pages and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegraph.functions import text as X
from notegraph.operators.windows import first_owner


def load_topics(pages: DataFrame, inactive: tuple[str, ...] = ("paused", "rejected")) -> tuple[DataFrame, DataFrame]:
    """(topics, quarantined) of ``pages (rel_path, stem, type, slug, aliases, status, errors)``.

    Pages of another type and inactive ones are left out; those of a bad shape, or whose slug or alias an earlier path
    owns, are quarantined with a reason.
    """
    rows = pages.where(F.col("type") == "topic")
    shape = (
        F.when(~F.col("slug").eqNullSafe(F.col("stem")), "slug is not the file name")
        .when(F.array_contains(F.coalesce("errors", F.array().cast("array<string>")), "aliases"), "aliases are no list")
    )
    rows = rows.withColumn("reason", shape)
    bad = rows.where(F.col("reason").isNotNull()).select("rel_path", "reason")
    good = rows.where(F.col("reason").isNull() & ~F.coalesce("status", F.lit("active")).isin(*inactive))
    owners = first_owner(good.select("rel_path", "slug", F.explode_outer("aliases").alias("alias"))).where(F.col("reason").isNotNull())
    topics = good.join(owners.select("rel_path"), "rel_path", "left_anti").drop("reason")
    return topics, bad.unionByName(owners)


def load_rejected(pages: DataFrame) -> DataFrame:
    """Names of topics that were turned down for good."""
    return pages.where((F.col("type") == "topic") & (F.col("status") == "rejected")).select(F.coalesce("slug", "stem").alias("slug")).distinct()


def topic_refs(arr: Column) -> Column:
    """The names behind a list of links, without alias, heading and ``.md``; empties are dropped."""
    bare = F.transform(arr, lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"^\s*\[\[|\]\]\s*$", ""), r"[#|].*$", ""), r"\.md$", "")))
    return F.filter(bare, lambda x: x != "")


def normalise_parent(c: Column) -> Column:
    """A parent as a bare name: one-element list, quotes, brackets, alias and ``.md`` are taken off; null if nothing is left."""
    t = F.trim(F.regexp_replace(c, r"""^\s*\[\s*(["'].*["'])\s*\]\s*$""", "$1"))
    t = F.trim(F.regexp_replace(t, r"""^["']|["']$""", ""))
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"^\[\[|\]\]$", ""), r"[#|].*$", ""), r"\.md$", "")
    return F.when(F.trim(t) != "", F.trim(t))


def replace_parent(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def dedup_case_insensitive(arr: Column) -> Column:
    """The first spelling of each value, in order."""
    low = F.transform(arr, lambda x: F.lower(x))
    return F.filter(arr, lambda x, i: F.array_position(low, F.lower(x)) == (i + 1).cast("long"))


def quote_title(block: Column) -> Column:
    """A header's title line in single quotes, inner quotes doubled; titles that are quoted already stay."""
    value = F.regexp_extract(block, r"(?m)^title:[ \t]*(.*)$", 1)
    bare = X.strip(value)
    quoted = F.concat(F.lit("title: '"), F.replace(bare, F.lit("'"), F.lit("''")), F.lit("'"))
    done = bare.rlike(r"""^(".*"|'.*')$""") | (bare == "")
    line = F.concat(F.lit("title:"), F.regexp_extract(block, r"(?m)^title:([ \t]*.*)$", 1))
    return F.when(done, block).otherwise(F.replace(block, line, quoted))


def strip_unknown_links(pages: DataFrame, known: DataFrame, text: str = "body") -> DataFrame:
    """``(rel_path, body, unlinked)``: wiki links whose target is not in ``known (target)`` keep their label only.

    The text is cut at its links, which are joined with the known names and put back in order.
    """
    pattern = r"\[\[([^\]\[]+)\]\]"
    cut = pages.select("rel_path", F.split(F.regexp_replace(text, pattern, "\u0001"), "\u0001").alias("parts"), F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("inner"))
    each = cut.select("rel_path", F.posexplode("inner").alias("pos", "link"))
    each = each.withColumn("target", F.trim(F.regexp_replace(F.regexp_replace("link", r"[#|].*$", ""), r"\.md$", "")))
    label = F.when(F.col("link").contains("|"), F.regexp_replace("link", r"^[^|]*\|", "")).otherwise(F.col("target"))
    each = each.join(known.select("target").distinct().withColumn("known", F.lit(True)), "target", "left")
    new = F.when(F.col("known"), F.concat(F.lit("[["), "link", F.lit("]]"))).otherwise(label)
    done = each.groupBy("rel_path").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", new.alias("new")))), lambda x: x["new"]).alias("links"), F.count_if(F.col("known").isNull()).alias("unlinked"))
    out = cut.join(done, "rel_path", "left")
    links = F.coalesce("links", F.array().cast("array<string>"))
    whole = F.array_join(F.flatten(F.transform(F.arrays_zip("parts", links.alias("l")), lambda x: F.array(x["parts"], F.coalesce(x["l"], F.lit(""))))), "")
    return out.select("rel_path", whole.alias("body"), F.coalesce("unlinked", F.lit(0)).alias("unlinked"))


def split_verified(text: Column, n_sources: Column) -> Column:
    """``struct(kept, inferences)``: claims whose citations all name a source, and the others."""
    c = X.claims(text)
    return F.struct(F.filter(c, lambda x: X.verified(x, n_sources)).alias("kept"), F.filter(c, lambda x: ~X.verified(x, n_sources)).alias("inferences"))


def assemble_page(title: Column, summary: Column, facts: Column, contradictions: Column, inferences: Column, sources: Column) -> Column:
    """A page of fixed sections; empty ones are left out."""
    items = lambda a: F.array_join(F.transform(a, lambda x: F.concat(F.lit("- "), x)), "\n")
    section = lambda head, a: F.when(F.size(a) > 0, F.concat(F.lit(f"## {head}\n"), items(a)))
    callout = F.when(F.size(contradictions) > 0, F.concat(F.lit("> [!warning] Contradictions\n"), F.array_join(F.transform(contradictions, lambda x: F.concat(F.lit("> - "), x)), "\n")))
    parts = F.array(F.concat(F.lit("# "), title), F.when(F.coalesce(summary, F.lit("")) != "", summary), section("Facts", facts), callout, section("Inferences", inferences), section("Sources", sources))
    return F.array_join(F.array_compact(parts), "\n\n")


def clean_model_row(d: Column) -> Column:
    """A model's JSON answer with defaults: confidence in 0..1, unknown org and context are personal."""
    r = F.from_json(d, "type string, org string, context string, people array<string>, tags array<string>, confidence double, reason string")
    org = F.when(F.lower(F.coalesce(r["org"], F.lit("unknown"))) == "unknown", "Personal").otherwise(r["org"])
    context = F.when(F.lower(F.coalesce(r["context"], F.lit("unknown"))) == "unknown", "personal").otherwise(r["context"])
    empty = F.array().cast("array<string>")
    return F.struct(
        F.coalesce(r["type"], F.lit("note")).alias("type"), org.alias("org"), context.alias("context"), F.coalesce(r["people"], empty).alias("people"), F.coalesce(r["tags"], empty).alias("tags"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(r["confidence"], F.lit(0.0)))).alias("confidence"), F.coalesce(r["reason"], F.lit("")).alias("reason"),
    )


def coerce_response(c: Column) -> Column:
    """``struct(value, error)``: the object of a JSON text, unwrapped from a lone outer key or ``properties``; an echo of
    the schema is an error."""
    keys = F.json_object_keys(c)
    outer = F.get_json_object(c, "$.properties")
    lone = F.when(F.size(keys) == 1, F.call_function("get_json_object", c, F.concat(F.lit("$."), F.get(keys, F.lit(0)))))
    echo = F.coalesce(F.get_json_object(c, "$.type") == "object", F.lit(False)) & outer.isNotNull() & (F.coalesce(F.size(F.json_object_keys(outer)), F.lit(0)) > 0) & outer.contains('"type"')
    inner = F.coalesce(outer, F.when(F.json_object_keys(lone).isNotNull(), lone))
    value = F.when(echo | keys.isNull(), F.lit(None)).otherwise(F.coalesce(inner, c))
    return F.struct(value.alias("value"), F.when(keys.isNull(), "no object").when(echo, "schema echo").alias("error"))


def build_prompt(schema: Column, whitelist: Column, aliases: Column, sources: Column, most_schema: int = 1500, most_links: int = 50) -> Column:
    """Prompt text: capped schema, link names, aliases and numbered sources."""
    numbered = F.transform(sources, lambda s, i: F.concat(F.lit("[B"), (i + 1).cast("string"), F.lit("] "), s))
    return F.concat_ws("\n\n", F.left(schema, F.lit(most_schema)), F.concat(F.lit("Links: "), F.array_join(F.slice(whitelist, 1, most_links), ", ")), F.concat(F.lit("Aliases: "), F.array_join(aliases, ", ")), F.array_join(numbered, "\n"))


def hub_stub(hub: Column, vault: Column) -> Column:
    return F.format_string("---\ntype: hub\nvault: %s\n---\n# %s\n", vault, hub)


def report_line(i: Column, chars: Column, name: Column, preview: Column, width: int = 55) -> Column:
    short = F.when(F.length(name) > width, F.concat(F.left(name, F.lit(width - 3)), F.lit("..."))).otherwise(F.rpad(name, width, " "))
    return F.concat(F.format_string("%4d %7d ", i, chars), short, F.lit(" "), preview)


def report_sections(lines: DataFrame, sections: list[str], default: str = "none") -> DataFrame:
    """``lines (vault, section, line)``: per vault and section the sorted lines, or a default line."""
    got = lines.groupBy("vault", "section").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("text"))
    frame = lines.select("vault").distinct().select("vault", F.explode(F.array(*map(F.lit, sections))).alias("section"))
    return frame.join(got, ["vault", "section"], "left").withColumn("text", F.coalesce("text", F.lit(default)))


def topic_table(rows: DataFrame, default: str = "No topics registered yet.") -> DataFrame:
    """``rows (slug, n_sources, updated, hash_changed)`` as the lines of a table, ``(pos, slug, line)``; without rows one
    default line. Positions 0 and 1 are the head's; the others follow the names."""
    changed = F.when(F.col("hash_changed"), "yes").when(~F.col("hash_changed"), "no")
    body = rows.select(F.lit(2).alias("pos"), "slug", X.md_row(F.col("slug"), F.col("n_sources").cast("string"), F.col("updated"), changed).alias("line"))
    some = rows.agg((F.count("*") > 0).alias("some"))
    head = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(x).alias("line")) for i, x in enumerate(("| Topic | Sources | Last synthesis | Changed |", "|---|---:|---|---|"))])
    none = F.array(F.struct(F.lit(0).alias("pos"), F.lit(default).alias("line")))
    first = some.select(F.explode(F.when(F.col("some"), head).otherwise(none)).alias("x")).select("x.pos", F.lit("").alias("slug"), "x.line")
    return first.unionByName(body)


def rewrite_stats(rows: DataFrame) -> DataFrame:
    """``rows (changed, resolved, unresolved)``: totals of a rewriting job."""
    return rows.agg(F.count("*").alias("scanned"), F.count_if("changed").alias("changed"), F.coalesce(F.sum("resolved"), F.lit(0)).alias("converted"), F.coalesce(F.sum("unresolved"), F.lit(0)).alias("unresolved"))


def home_summary(metrics: DataFrame, queue: DataFrame, freshness: DataFrame) -> DataFrame:
    """Per vault: ratio, queue length where known, and how many topics are stale."""
    stale = freshness.groupBy("vault").agg(F.count_if("hash_changed").alias("stale"), F.count("*").alias("topics"))
    return metrics.join(queue, "vault", "left").join(stale, "vault", "left").select("vault", "ratio", "queued", F.coalesce("topics", F.lit(0)).alias("topics"), F.coalesce("stale", F.lit(0)).alias("stale"))
