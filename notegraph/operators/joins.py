"""Joins between notes, topics, hubs, links and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegraph.functions import text as X
from notegraph.operators.matching import match_topics  # noqa: F401
from notegraph.session import Scratch, materialize

def unmatched_notes(notes: DataFrame, matches: DataFrame) -> DataFrame:
    return notes.join(matches.select("rel_path").distinct(), "rel_path", "left_anti")


NUMBERED = r"\.\d+\.md$"


def numbered_pairs(notes: DataFrame) -> DataFrame:
    """``(copy, base)``: ``Title.N.md`` with the ``Title.md`` beside it."""
    copies = notes.where(F.col("rel_path").rlike(NUMBERED)).select(F.col("vault"), F.col("rel_path").alias("copy"), F.regexp_replace("rel_path", NUMBERED, ".md").alias("base"))
    bases = notes.select("vault", F.col("rel_path").alias("base"))
    return copies.join(bases, ["vault", "base"])


def exact_copies(notes: DataFrame, body: str = "body") -> DataFrame:
    """The numbered pairs whose texts are equal, compared by digest."""
    digests = notes.select("vault", "rel_path", F.sha2(body, 256).alias("sha"))
    pairs = numbered_pairs(notes)
    a = digests.select("vault", F.col("rel_path").alias("copy"), F.col("sha").alias("copy_sha"))
    b = digests.select("vault", F.col("rel_path").alias("base"), F.col("sha").alias("base_sha"))
    return pairs.join(a, ["vault", "copy"]).join(b, ["vault", "base"]).where(F.col("copy_sha") == F.col("base_sha")).select("vault", "copy", "base")


def orphan_copies(notes: DataFrame) -> DataFrame:
    copies = notes.where(F.col("rel_path").rlike(NUMBERED)).withColumn("base", F.regexp_replace("rel_path", NUMBERED, ".md"))
    return copies.join(notes.select("vault", F.col("rel_path").alias("base")), ["vault", "base"], "left_anti").select("vault", "rel_path")


def similar_numbered(notes: DataFrame, near: float = 0.99, review: float = 0.9) -> DataFrame:
    """``(copy, tier)``: ``orphan``, ``near_dup``, ``review`` or ``different``, by similarity with the base."""
    texts = notes.select("vault", "rel_path", "body")
    pairs = numbered_pairs(notes)
    pairs = pairs.join(texts.select("vault", F.col("rel_path").alias("copy"), F.col("body").alias("x")), ["vault", "copy"])
    pairs = pairs.join(texts.select("vault", F.col("rel_path").alias("base"), F.col("body").alias("y")), ["vault", "base"])
    # equal texts need no Python
    same = pairs.where(F.col("x") == F.col("y")).select("vault", "copy", F.lit(1.0).alias("similarity"))
    other = pairs.where(F.col("x") != F.col("y")).withColumn("bound", X.similarity_bound(F.col("x"), F.col("y")))
    # lengths alone may tell that two texts are different; then no measure is taken, and there is none to report
    apart = other.where(F.col("bound") < review).select("vault", "copy", F.lit(None).cast("double").alias("similarity"))
    other = other.where(F.col("bound") >= review).select("vault", "copy", X.similarity("y", "x").alias("similarity"))
    other = other.unionByName(apart)
    tier = F.when(F.col("similarity") >= near, "near_dup").when(F.col("similarity") >= review, "review").otherwise("different")
    found = same.unionByName(other).withColumn("tier", tier)
    lost = orphan_copies(notes).select("vault", F.col("rel_path").alias("copy"), F.lit(None).cast("double").alias("similarity"), F.lit("orphan").alias("tier"))
    return found.unionByName(lost)


def title_lookup(notes: DataFrame) -> DataFrame:
    """Title to file stem; of equal titles the greatest path wins."""
    return notes.groupBy("title").agg(F.max_by("stem", "rel_path").alias("stem"))


def resolve_by_fallback(keys: DataFrame, lookup: DataFrame, key: str = "title") -> DataFrame:
    """Adds ``target`` and ``tier``: the exact title, else the lower-cased one, else the one with white space collapsed."""
    out = keys
    for tier, norm in (("exact", lambda c: c), ("lower", F.lower), ("normal", X.normalise_title)):
        side = lookup.groupBy(norm(F.col("title")).alias(f"_{tier}")).agg(F.max("stem").alias(f"_stem_{tier}"))
        out = out.join(side, norm(out[key]) == side[f"_{tier}"], "left").drop(f"_{tier}")
    tier = F.when(F.col("_stem_exact").isNotNull(), "exact").when(F.col("_stem_lower").isNotNull(), "lower").when(F.col("_stem_normal").isNotNull(), "normal")
    return out.select(*keys.columns, F.coalesce("_stem_exact", "_stem_lower", "_stem_normal").alias("target"), tier.alias("tier"))


def rewrite_links(notes: DataFrame, targets: DataFrame, text: str = "body") -> DataFrame:
    """Markdown links whose address is known become wiki links: ``(rel_path, body, resolved, unresolved)``.

    ``targets (url, target)``. A text is cut at its links, the links are joined, and the parts are put together again.
    """
    pattern = r"\[([^\]]*)\]\((https?://[^)\s]+)\)"
    cut = notes.select(
        "rel_path",
        F.split(F.regexp_replace(text, pattern, "\u0001"), "\u0001").alias("parts"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("labels"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("urls"),
    )
    each = cut.select("rel_path", F.posexplode(F.arrays_zip("whole", "labels", "urls")).alias("pos", "l")).select("rel_path", "pos", "l.whole", "l.labels", F.col("l.urls").alias("url"))
    new = F.when(F.col("target").isNull(), F.col("whole")).when(F.col("labels") == F.col("target"), F.concat(F.lit("[["), "target", F.lit("]]"))).otherwise(F.concat(F.lit("[["), "target", F.lit("|"), "labels", F.lit("]]")))
    done = each.join(targets, "url", "left").withColumn("new", new)
    done = done.groupBy("rel_path").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "new"))), lambda x: x["new"]).alias("links"), F.count("target").alias("resolved"), F.count_if(F.col("target").isNull()).alias("unresolved")
    )
    whole = F.array_join(F.flatten(F.transform(F.arrays_zip("parts", "links"), lambda x: F.array(x["parts"], F.coalesce(x["links"], F.lit(""))))), "")
    out = cut.join(done, "rel_path", "left").withColumn("links", F.coalesce("links", F.array().cast("array<string>")))
    return out.select("rel_path", whole.alias("body"), F.coalesce("resolved", F.lit(0)).alias("resolved"), F.coalesce("unresolved", F.lit(0)).alias("unresolved"))


def relink_renamed(links: DataFrame, renames: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``links (keys, rel_path, target)`` with the new name of targets that ``renames (keys, old, new)`` renames; ``.md`` is ignored."""
    bare = links.withColumn("old", F.regexp_replace("target", r"\.md$", ""))
    out = bare.join(renames, [*keys, "old"], "left")
    return out.select(*keys, "rel_path", "target", F.coalesce("new", "target").alias("new_target"), F.col("new").isNotNull().alias("changed"))


def orphan_parents(notes: DataFrame, up: str = "up") -> DataFrame:
    """Notes whose parent exists neither at the root nor beside the note. Two equi-joins take the place of an OR."""
    asked = notes.where(F.col(up).isNotNull()).select("vault", "rel_path", up)
    folder = F.regexp_extract("rel_path", r"^(.*/)?[^/]*$", 1)
    asked = asked.withColumn("at_root", F.concat(up, F.lit(".md"))).withColumn("beside", F.concat(folder, up, F.lit(".md")))
    have = notes.select("vault", F.col("rel_path").alias("have")).distinct()
    a = have.withColumnRenamed("have", "at_root").withColumn("in_root", F.lit(True))
    b = have.withColumnRenamed("have", "beside").withColumn("in_folder", F.lit(True))
    out = asked.join(a, ["vault", "at_root"], "left").join(b, ["vault", "beside"], "left")
    return out.where(F.col("in_root").isNull() & F.col("in_folder").isNull()).select("vault", "rel_path", up)


def dangling_refs(refs: DataFrame, topics: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``refs (vault, rel_path, slug)`` without a topic; with ``keys=["slug"]`` topics hold for all vaults."""
    keys = keys or ["vault", "slug"]
    return refs.join(topics.select(*keys).distinct(), keys, "left_anti")


def missing_hubs(hubs: DataFrame, pages: DataFrame, refs: DataFrame) -> DataFrame:
    """Canonical hubs without a page: ``(hub, references, status)``."""
    gone = hubs.select("hub").distinct().join(pages.select(F.col("stem").alias("hub")).distinct(), "hub", "left_anti")
    counts = refs.groupBy("hub").agg(F.count("*").alias("references"))
    n = F.coalesce("references", F.lit(0))
    return gone.join(counts, "hub", "left").select("hub", n.alias("references"), F.when(n > 0, "referenced").otherwise("unused").alias("status"))


def lint_hubs(pages: DataFrame) -> DataFrame:
    """``pages (stem, up)`` that are hubs: those that name themselves or a missing page as parent."""
    have = pages.select(F.col("stem").alias("up")).distinct().withColumn("found", F.lit(True))
    out = pages.where(F.col("up").isNotNull()).join(have, "up", "left")
    problem = F.when(F.col("up") == F.col("stem"), "self").when(F.col("found").isNull(), "missing")
    return out.select("stem", "up", problem.alias("problem")).where(F.col("problem").isNotNull())


def hub_for_type(df: DataFrame, hubs: DataFrame, default: str = "[[Personal]]") -> DataFrame:
    return df.join(hubs.select("type", "up"), "type", "left").withColumn("up", F.coalesce("up", F.lit(default)))


def topic_freshness(topics: DataFrame, sets: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Number of sources, last synthesis, and whether the set's hash moved: true, false, or null where one is unknown."""
    out = topics.join(sets.select("slug", "n_sources", F.col("set_hash").alias("now_hash")), "slug", "left")
    return out.select(*keys, "slug", F.coalesce("n_sources", F.lit(0)).alias("n_sources"), "updated", (F.col("source_set_hash") != F.col("now_hash")).alias("hash_changed"))


def desired_backlinks(matches: DataFrame) -> DataFrame:
    return matches.groupBy("rel_path").agg(F.array_sort(F.collect_set("slug")).alias("desired"))


def reconcile_backlinks(notes: DataFrame, desired: DataFrame, slugs: DataFrame, wiki: bool = False) -> DataFrame:
    """``notes (rel_path, topics)``: links by hand stay in place, managed ones become the desired set.

    Result: rel_path, topics, removed (managed links that are no longer there), status (``updated`` or ``skipped``).
    ``slugs (slug)`` are the managed names. With ``wiki`` links are ``[[name]]``, and only such links are managed.
    """
    links = notes.select("rel_path", F.posexplode_outer("topics").alias("pos", "link"))
    links = links.withColumn("slug", X.slug_of_link(F.col("link")) if wiki else F.col("link"))
    managed = slugs.select("slug").distinct().withColumn("managed", F.lit(True))
    split = links.join(managed, "slug", "left").groupBy("rel_path").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("link").isNotNull() & F.col("managed").isNull(), F.struct("pos", "link")))), lambda x: x["link"]).alias("by_hand"),
        F.collect_list(F.when(F.col("managed"), F.col("link"))).alias("old"),
    )
    out = notes.join(split, "rel_path").join(desired, "rel_path", "left").withColumn("desired", F.coalesce("desired", F.array().cast("array<string>")))
    if wiki:
        out = out.withColumn("desired", F.transform("desired", lambda x: F.concat(F.lit("[["), x, F.lit("]]"))))
    new = F.concat("by_hand", F.array_except("desired", "by_hand"))
    before = F.coalesce("topics", F.array().cast("array<string>"))
    removed = F.size(F.filter("old", lambda x: ~F.array_contains(new, x)))
    return out.select("rel_path", new.alias("topics"), removed.alias("removed"), F.when(new == before, "skipped").otherwise("updated").alias("status"))


#: Notes of a block: those of an anchor that has more meet block by block.
BLOCK = 2048


def anchor_edges(note_anchor: DataFrame) -> DataFrame:
    """Pairs ``(src, dst)`` of notes that share an anchor, ``note_anchor (node, anchor)``, each once and src < dst.

    The notes of an anchor are dealt to blocks, and each pair of blocks is a key of the join, so an anchor of very many
    notes is spread over all tasks; its notes are repeated once for each of its blocks. There are few such anchors.
    """
    large = note_anchor.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("anchor", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = note_anchor.join(large, "anchor", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    upper = rows.select("anchor", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"), F.col("node").alias("a"))
    lower = rows.select("anchor", F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"), F.col("node").alias("b"))
    pairs = upper.join(lower, ["anchor", "i", "j"]).where(F.when(F.col("i") == F.col("j"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b")))
    return pairs.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()


def resolve_collisions(proposals: DataFrame, taken_slugs: DataFrame, taken_aliases: DataFrame) -> DataFrame:
    """``proposals (pos, slug, aliases)`` without taken slugs and aliases; of two proposals the earlier one wins.

    As if taken one by one in the order of ``pos``: a proposal whose slug is taken, or whose aliases all are, is
    rejected and takes nothing; else it takes its slug and its free aliases. Each round decides all proposals that are
    the first of what they ask for, and all that only one earlier proposal stands in the way of, down whole trees of such
    (`_outcomes`); then it closes what was taken. So a chain of conflicts takes one round.
    """
    scratch = Scratch(proposals.sparkSession, "collisions")
    rows = proposals.where(F.coalesce("slug", F.lit("")) != "").select("pos", "slug", F.posexplode("aliases").alias("alias_pos", "alias"))
    rows = scratch.write(rows.withColumn("key", X.casefold("alias")), "rows")
    slugs, keys = taken_slugs.select("slug"), taken_aliases.select(X.casefold("alias").alias("key"))
    accepted, rounds = f"{scratch.folder}/accepted", 0
    while True:
        rows = rows.join(slugs.distinct(), "slug", "left_anti").join(keys.distinct(), "key", "left_anti").select("pos", "slug", "alias_pos", "alias", "key")
        rows = scratch.write(rows, "rows")
        if rows.isEmpty():
            break
        asked = rows.select("pos", F.lit(True).alias("is_slug"), F.col("slug").alias("k")).union(rows.select("pos", F.lit(False), "key")).distinct()
        first = asked.groupBy("is_slug", "k").agg(F.min("pos").alias("first"))
        asked = scratch.write(asked.join(first, ["is_slug", "k"]), "asked")
        second = asked.where("pos <> first").groupBy("is_slug", "k").agg(F.min("pos").alias("second"))
        asked = scratch.write(asked.join(second, ["is_slug", "k"], "left"), "asked")
        val = _outcomes(asked, scratch)
        lost = asked.where("not is_slug and pos <> first").join(val.select(F.col("pos").alias("first"), F.col("val").alias("v")), "first").select("pos", F.col("k").alias("key"), "v")
        lost = scratch.write(lost, "lost")
        # what stands in the way may be unknown yet, though the outcome is known: then it is known later, with its aliases
        later = lost.where("v is null").select("pos").distinct()
        won = rows.join(val.where("val").join(later, "pos", "left_anti").select("pos"), "pos", "left_semi").join(lost.where("v").select("pos", "key"), ["pos", "key"], "left_anti")
        won = scratch.write(won.select(*rows.columns), f"won-{rounds}")
        won.write.mode("append").parquet(accepted)
        gone = scratch.write(val.where("not val").select("pos").union(won.select("pos").distinct()), "gone")
        rows, rounds = rows.join(gone, "pos", "left_anti"), rounds + 1
        slugs, keys = won.select("slug"), won.select("key")
    out = rows.sparkSession.read.schema(rows.schema).parquet(accepted) if rounds else rows
    out = materialize(out.groupBy("pos", "slug").agg(F.transform(F.array_sort(F.collect_list(F.struct("alias_pos", "alias"))), lambda x: x["alias"]).alias("aliases")), "collisions")
    scratch.close()
    return out


def _outcomes(asked: DataFrame, scratch: Scratch) -> DataFrame:
    """``asked (pos, is_slug, k, first, second)``, what open proposals ask for and the first two that do, to ``(pos, val)``:
    accepted, rejected, or null where that is not known yet.

    A proposal that is the first of all is accepted. One that a single earlier one stands in the way of is accepted
    anyway if its slug and some alias are its own, else it is the opposite of that one. Pointers to it are followed by
    doubling, so a chain's end is found in the logarithm of its length. Others wait.
    """
    behind = F.col("pos") != F.col("first")
    each = asked.groupBy("pos").agg(
        F.countDistinct(F.when(behind, F.col("first"))).alias("n"), F.min(F.when(behind, F.col("first"))).alias("to"), F.bool_or(behind & (F.col("pos") != F.col("second"))).alias("more"),
        F.bool_or(behind & F.col("is_slug")).alias("no_slug"), F.bool_or(~behind & ~F.col("is_slug")).alias("own_alias"),
    )
    waits = (F.col("n") > 1) | F.coalesce("more", F.lit(False))
    sure = (F.col("n") == 0) | (~F.col("no_slug") & F.col("own_alias"))
    now = each.select("pos", F.when(~waits & ~sure, F.col("to")).alias("to"), F.when(~waits & sure, True).alias("val"), F.lit(True).alias("opposite"))
    now = scratch.write(now, "outcomes")
    while not (open_ := now.where("to is not null")).isEmpty():
        ahead = now.select(F.col("pos").alias("to"), F.col("to").alias("next"), F.col("val").alias("v"), F.col("opposite").alias("o"))
        met = open_.join(ahead, "to")
        done = F.col("next").isNull()
        step = met.select("pos", "next", F.when(done, F.col("v") != F.col("opposite")), F.when(done, F.col("opposite")).otherwise(F.col("opposite") != F.col("o"))).toDF("pos", "to", "val", "opposite")
        now = scratch.write(step.unionByName(now.where("to is null")), "outcomes")
    return now.select("pos", "val")


def pending_reviews(queue: DataFrame, notes: DataFrame, done: Column) -> tuple[DataFrame, DataFrame]:
    """(rows whose note still exists and is not done, number of hidden rows)."""
    open_ = notes.where(~done).select(F.col("rel_path").alias("path")).distinct()
    return queue.join(open_, "path", "left_semi"), queue.join(open_, "path", "left_anti").agg(F.count("*").alias("hidden"))


def pair_resources(notes: DataFrame, folders: DataFrame) -> DataFrame:
    """Notes with the folder of their attachments: ``_resources/<stem with _ for blanks>.resources``."""
    key = F.concat(F.lit("_resources/"), F.replace("stem", F.lit(" "), F.lit("_")), F.lit(".resources"))
    return notes.withColumn("resources", key).join(folders.select(F.col("path").alias("resources"), F.lit(True).alias("_has")), "resources", "left").withColumn("resources", F.when(F.col("_has"), F.col("resources"))).drop("_has")
