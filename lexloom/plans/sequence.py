"""Named queries that scan ordered chains: compression, snapshot merging and diffs, runs, segments."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window, functions as F

from lexloom import views
from lexloom.operators import sequence as s
from lexloom.plans.catalogue import query
from lexloom.session import importable
from lexloom.views import iso, with_views

_NUM = "num AS (SELECT norm, snap, day, row_number() OVER (PARTITION BY norm ORDER BY day, snap) AS n FROM (SELECT DISTINCT norm, snap, day FROM snap))"
_BLK = "blk AS (SELECT s.norm, num.n, s.block, max(s.txt) AS txt FROM snap s JOIN num ON s.norm = num.norm AND s.snap = num.snap GROUP BY ALL)"


def _blocks(spark, sf_dir):
    snaps = views.snapshots(spark, sf_dir)
    numbers = s.snapshot_numbers(snaps).select("norm", "snap", "n")
    return snaps.join(numbers, ["norm", "snap"]).groupBy("norm", "n", "block").agg(F.max("txt").alias("txt"))


@query("compress_consecutive", f"""{with_views('ver')},
o AS (SELECT norm, block, src, txt, lag(txt) OVER w AS before, row_number() OVER w AS k FROM ver
      WINDOW w AS (PARTITION BY norm, block ORDER BY coalesce(eff, pub), pub, src))
SELECT norm, block, src, txt FROM o WHERE k = 1 OR txt IS DISTINCT FROM before""")
def compress_consecutive(spark, sf_dir):
    return s.compress(views.versions(spark, sf_dir), ["norm", "block"], [F.coalesce("eff", "pub"), "pub", "src"], "txt").select("norm", "block", "src", "txt")


@query("compress_and_dedupe", f"""{with_views('ver')},
o AS (SELECT norm, src, block, eff, txt, lag(txt) OVER (PARTITION BY norm ORDER BY eff, src, block) AS before,
        row_number() OVER (PARTITION BY norm ORDER BY eff, src, block) AS k FROM ver WHERE eff IS NOT NULL),
c AS (SELECT *, row_number() OVER (PARTITION BY norm, eff, txt ORDER BY k) AS d FROM o WHERE k = 1 OR txt <> before)
SELECT norm, src, block, CAST(eff AS VARCHAR) AS eff, txt FROM c WHERE d = 1""")
def compress_and_dedupe(spark, sf_dir):
    dated = views.versions(spark, sf_dir).where("eff IS NOT NULL")
    kept = s.compress(dated, ["norm"], ["eff", "src", "block"], "txt")
    return s.first_by(kept, ["norm", "eff", "txt"], ["src", "block"]).select("norm", "src", "block", iso("eff").alias("eff"), "txt")


@query("fragment_changes", f"""{with_views('snap')}, {_NUM}, {_BLK},
c AS (SELECT norm, n, block, txt, lag(txt) OVER (PARTITION BY norm, block ORDER BY n) AS before FROM blk),
g AS (SELECT norm, n, count(*) FILTER (WHERE before IS NOT NULL AND before <> txt) AS changed,
        string_agg(CAST(block AS VARCHAR), ',' ORDER BY block) FILTER (WHERE before IS NOT NULL AND before <> txt) AS blocks FROM c GROUP BY norm, n)
SELECT norm, n, changed, blocks FROM g WHERE n = 1 OR changed > 0""")
def fragment_changes(spark, sf_dir):
    """A new block is a version but no change; snapshots without a change give no event, but for the first."""
    before = F.lag("txt").over(Window.partitionBy("norm", "block").orderBy("n"))
    rows = _blocks(spark, sf_dir).withColumn("changed", before.isNotNull() & (before != F.col("txt")))
    titles = F.slice(F.array_sort(F.collect_list(F.when(F.col("changed"), F.col("block")))), 1, 40)
    grouped = rows.groupBy("norm", "n").agg(F.count_if("changed").alias("changed"), titles.alias("titles"))
    text = F.when(F.size("titles") > 0, F.array_join(F.transform("titles", lambda x: x.cast("string")), ","))
    return grouped.where("n = 1 OR changed > 0").select("norm", "n", "changed", text.alias("blocks"))


@query("snapshot_diff_added_removed", f"""{with_views('snap')}, {_NUM}, {_BLK},
las AS (SELECT norm, max(n) AS last FROM num GROUP BY norm),
f AS (SELECT coalesce(a.norm, b.norm) AS norm, coalesce(a.n, b.n + 1) AS n, coalesce(a.block, b.block) AS block,
        CASE WHEN b.txt IS NULL THEN 'added' WHEN a.txt IS NULL THEN 'removed' WHEN a.txt <> b.txt THEN 'changed' END AS change
      FROM blk a FULL JOIN blk b ON a.norm = b.norm AND a.n = b.n + 1 AND a.block = b.block)
SELECT f.norm, f.n, f.block, f.change FROM f JOIN las ON f.norm = las.norm WHERE f.n <= las.last AND change IS NOT NULL""")
def snapshot_diff_added_removed(spark, sf_dir):
    return s.diff(views.snapshots(spark, sf_dir))


@query("snapshot_diff_changed", f"""{with_views('snap')}, {_NUM}, {_BLK},
f AS (SELECT a.norm, a.n, a.block, a.txt, b.txt AS old FROM blk a LEFT JOIN blk b ON a.norm = b.norm AND a.n = b.n + 1 AND a.block = b.block WHERE a.n > 1),
g AS (SELECT norm, n, string_agg(CAST(block AS VARCHAR), ',' ORDER BY block) FILTER (WHERE old IS NULL OR old <> txt) AS blocks FROM f GROUP BY norm, n)
SELECT norm, n, coalesce(blocks, 'art-' || n) AS blocks FROM g""")
def snapshot_diff_changed(spark, sf_dir):
    """Added or changed blocks; a snapshot without any falls back to a hint."""
    rows = _blocks(spark, sf_dir)
    old = rows.select("norm", (F.col("n") + 1).alias("n"), "block", F.col("txt").alias("old"))
    joined = rows.where("n > 1").join(old, ["norm", "n", "block"], "left")
    own = F.array_sort(F.collect_list(F.when(F.col("old").isNull() | (F.col("old") != F.col("txt")), F.col("block"))))
    grouped = joined.groupBy("norm", "n").agg(own.alias("own"))
    listed = F.array_join(F.transform("own", lambda x: x.cast("string")), ",")
    return grouped.select("norm", "n", F.when(F.size("own") > 0, listed).otherwise(F.concat(F.lit("art-"), "n")).alias("blocks"))


@query("merge_snapshots", f"""{with_views('snap')}, {_NUM}, {_BLK},
o AS (SELECT norm, block, n, txt, lag(txt) OVER (PARTITION BY norm, block ORDER BY n) AS before, min(n) OVER (PARTITION BY norm, block) AS seen FROM blk),
k AS (SELECT norm, block, n, txt, seen FROM o WHERE before IS NULL OR before <> txt)
SELECT norm, block, CAST(min(seen) AS BIGINT) AS first_seen, count(*) AS n_versions, string_agg(n || '=' || txt, ';' ORDER BY n) AS chain FROM k GROUP BY norm, block""")
def merge_snapshots(spark, sf_dir):
    """Whole snapshots become one version chain per block, unchanged restatements dropped."""
    kept = s.compress(_blocks(spark, sf_dir), ["norm", "block"], ["n"], "txt")
    chain = F.array_sort(F.collect_list(F.struct("n", "txt")))
    text = F.array_join(F.transform(chain, lambda x: F.concat_ws("=", x["n"], x["txt"])), ";")
    return kept.groupBy("norm", "block").agg(F.min("n").alias("first_seen"), F.count(F.lit(1)).alias("n_versions"), text.alias("chain"))


@query("first_seen_order", f"""{with_views('snap')}, {_NUM}, {_BLK},
f AS (SELECT norm, block, min(n) AS seen FROM blk GROUP BY norm, block)
SELECT norm, block, row_number() OVER (PARTITION BY norm ORDER BY seen, block) AS place FROM f""")
def first_seen_order(spark, sf_dir):
    seen = _blocks(spark, sf_dir).groupBy("norm", "block").agg(F.min("n").alias("seen"))
    return seen.select("norm", "block", F.row_number().over(Window.partitionBy("norm").orderBy("seen", "block")).cast("bigint").alias("place"))


@query("snapshot_latest_order", f"""{with_views('snap')}, {_NUM}, {_BLK},
f AS (SELECT norm, block, min(n) AS seen, max(n) AS last_n FROM blk GROUP BY norm, block),
g AS (SELECT *, last_n = max(last_n) OVER (PARTITION BY norm) AS live FROM f)
SELECT norm, block, live, row_number() OVER (PARTITION BY norm ORDER BY live DESC, CASE WHEN live THEN block ELSE seen * 1000 + block END) AS place FROM g""")
def snapshot_latest_order(spark, sf_dir):
    """The newest snapshot's blocks in their order, then removed ones as they first came."""
    seen = _blocks(spark, sf_dir).groupBy("norm", "block").agg(F.min("n").alias("seen"), F.max("n").alias("last_n"))
    live = F.col("last_n") == F.max("last_n").over(Window.partitionBy("norm"))
    order = Window.partitionBy("norm").orderBy(F.desc("live"), F.when(F.col("live"), F.col("block")).otherwise(F.col("seen") * 1000 + F.col("block")))
    return seen.withColumn("live", live).select("norm", "block", "live", F.row_number().over(order).cast("bigint").alias("place"))


@query("versions_by_start", f"""{with_views('ver')}
SELECT norm, block, string_agg(CAST(coalesce(eff, pub) AS VARCHAR), ',' ORDER BY coalesce(eff, pub), src) AS starts, count(*) AS n FROM ver GROUP BY norm, block""")
def versions_by_start(spark, sf_dir):
    starts = F.array_sort(F.collect_list(F.struct(F.coalesce("eff", "pub").alias("at"), "src")))
    return views.versions(spark, sf_dir).groupBy("norm", "block").agg(F.array_join(F.transform(starts, lambda x: x["at"].cast("string")), ",").alias("starts"), F.count(F.lit(1)).alias("n"))


@query("latest_nonempty_title", """SELECT doc_id, lang, last_value(CASE WHEN n_chars > 1500 THEN source END IGNORE NULLS) OVER
  (PARTITION BY lang ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS title FROM documents""")
def latest_nonempty_title(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang", F.when(F.col("n_chars") > 1500, F.col("source")).alias("own"))
    return docs.select("doc_id", "lang", F.last("own", ignorenulls=True).over(s.running(["lang"], ["doc_id"])).alias("title"))


@query("interval_gaps", f"""{with_views('ver')},
o AS (SELECT norm, block, src, eff AS starts, lag(eff + qty) OVER (PARTITION BY norm ORDER BY eff, src, block) AS before_ends FROM ver WHERE eff IS NOT NULL)
SELECT norm, block, src, CAST(starts - (before_ends + 1) AS INT) AS days, CASE WHEN starts - (before_ends + 1) > 1 THEN 'gap' ELSE 'overlap' END AS kind
FROM o WHERE before_ends IS NOT NULL AND (starts - (before_ends + 1) > 1 OR starts - (before_ends + 1) < 0)""")
def interval_gaps(spark, sf_dir):
    ends = F.lag(F.date_add("eff", F.col("qty"))).over(Window.partitionBy("norm").orderBy("eff", "src", "block"))
    rows = views.versions(spark, sf_dir).where("eff IS NOT NULL").withColumn("days", F.datediff("eff", F.date_add(ends, 1)))
    return rows.where("days > 1 OR days < 0").select("norm", "block", "src", "days", F.when(F.col("days") > 1, "gap").otherwise("overlap").alias("kind"))


@query("last_occurrence", f"""{with_views('log')},
o AS (SELECT norm, id, row_number() OVER (PARTITION BY kind ORDER BY id) AS i, kind FROM log)
SELECT kind, norm, max(i) AS last_index, count(*) AS uses FROM o GROUP BY kind, norm""")
def last_occurrence(spark, sf_dir):
    index = F.row_number().over(Window.partitionBy("kind").orderBy("id")).cast("bigint")
    return views.log(spark, sf_dir).withColumn("i", index).groupBy("kind", "norm").agg(F.max("i").alias("last_index"), F.count(F.lit(1)).alias("uses"))


@query("prefix_mismatch", f"""{with_views('log')},
e AS (SELECT norm, kind, row_number() OVER (PARTITION BY norm ORDER BY id) AS k FROM log),
p AS (SELECT norm, kind, row_number() OVER (PARTITION BY norm ORDER BY day, value, id) AS k FROM log WHERE id % 11 <> 0)
SELECT coalesce(e.norm, p.norm) AS norm, min(coalesce(e.k, p.k)) FILTER (WHERE p.kind IS NOT NULL AND e.kind IS DISTINCT FROM p.kind) AS first_mismatch, count(p.k) AS published, count(e.k) AS expected
FROM e FULL JOIN p ON e.norm = p.norm AND e.k = p.k GROUP BY 1""")
def prefix_mismatch(spark, sf_dir):
    """Is the published sequence a prefix of the expected one?  Both numbered, one join per place."""
    log = views.log(spark, sf_dir)
    number = lambda *order: F.row_number().over(Window.partitionBy("norm").orderBy(*order)).cast("bigint")
    want = log.select("norm", number("id").alias("k"), F.col("kind").alias("want"))
    have = log.where("id % 11 <> 0").select("norm", number("day", "value", "id").alias("k"), F.col("kind").alias("have"))
    both = want.join(have, ["norm", "k"], "full")
    wrong = F.when(F.col("have").isNotNull() & ~F.col("want").eqNullSafe(F.col("have")), F.col("k"))
    return both.groupBy("norm").agg(F.min(wrong).alias("first_mismatch"), F.count("have").alias("published"), F.count("want").alias("expected"))


@query("missing_then_present", f"""{with_views('log')},
o AS (SELECT norm, id, kind = 'error' AS missing, max(CAST(kind = 'error' AS INT)) OVER (PARTITION BY norm ORDER BY day, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM log)
SELECT norm, count(*) AS violations FROM o WHERE NOT missing AND before = 1 GROUP BY norm""")
def missing_then_present(spark, sf_dir):
    earlier = Window.partitionBy("norm").orderBy("day", "id").rowsBetween(Window.unboundedPreceding, -1)
    missing = F.col("kind") == "error"
    rows = views.log(spark, sf_dir).select("norm", missing.alias("missing"), F.max(missing.cast("int")).over(earlier).alias("before"))
    return rows.where("NOT missing AND before = 1").groupBy("norm").agg(F.count(F.lit(1)).alias("violations"))


@query("older_than_newest", f"""{with_views('ver')},
m AS (SELECT *, max(CASE WHEN txt = 'N' THEN pub END) OVER (PARTITION BY norm) AS newest FROM ver)
SELECT norm, block, src FROM m WHERE txt <> 'N' AND pub < newest""")
def older_than_newest(spark, sf_dir):
    newest = F.max(F.when(F.col("txt") == "N", F.col("pub"))).over(Window.partitionBy("norm"))
    return views.versions(spark, sf_dir).withColumn("newest", newest).where("txt <> 'N' AND pub < newest").select("norm", "block", "src")


@query("first_failure_blocks", f"""{with_views('log')},
o AS (SELECT norm, id, kind, max(CAST(value > 180 AS INT)) OVER (PARTITION BY norm ORDER BY day, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM log)
SELECT norm, id, kind, coalesce(before, 0) = 1 AS skipped FROM o""")
def first_failure_blocks(spark, sf_dir):
    earlier = Window.partitionBy("norm").orderBy("day", "id").rowsBetween(Window.unboundedPreceding, -1)
    failed = F.coalesce(F.max((F.col("value") > 180).cast("int")).over(earlier), F.lit(0)) == 1
    return views.log(spark, sf_dir).select("norm", "id", "kind", failed.alias("skipped"))


@query("pair_headings", """WITH o AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text, lag(role) OVER w AS last_role
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, CASE WHEN role = 'user' AND next_role = 'assistant' THEN left(text, 20) || ' / ' || left(next_text, 20) ELSE left(text, 20) END AS heading
FROM o WHERE NOT (role = 'assistant' AND last_role IS NOT DISTINCT FROM 'user')""")
def pair_headings(spark, sf_dir):
    """A number paragraph and the title after it become one heading; the title's own row goes."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = views.table(spark, sf_dir, "conversations").withColumns({"next_role": F.lead("role").over(w), "next_text": F.lead("text").over(w), "last_role": F.lag("role").over(w)})
    paired = (F.col("role") == "user") & (F.col("next_role") == "assistant")
    heading = F.when(paired, F.concat(F.left("text", F.lit(20)), F.lit(" / "), F.left("next_text", F.lit(20)))).otherwise(F.left("text", F.lit(20)))
    return rows.where(~((F.col("role") == "assistant") & F.col("last_role").eqNullSafe("user"))).select("conv_id", "turn", heading.alias("heading"))


@query("quote_merge", f"""{with_views('log')},
o AS (SELECT *, CASE WHEN kind = lag(kind) OVER (PARTITION BY norm ORDER BY day, id) THEN 0 ELSE 1 END AS starts FROM log),
g AS (SELECT *, sum(starts) OVER (PARTITION BY norm ORDER BY day, id ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT norm, CAST(run AS BIGINT) AS run, min(kind) AS kind, count(*) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY day, id) AS ids FROM g GROUP BY norm, run""")
def quote_merge(spark, sf_dir):
    """Adjacent rows of one kind become one."""
    before = F.lag("kind").over(Window.partitionBy("norm").orderBy("day", "id"))
    rows = s.segment(views.log(spark, sf_dir).withColumn("before", before), ["norm"], ["day", "id"], ~F.col("kind").eqNullSafe(F.col("before")))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("day", "id"))), lambda x: x["id"].cast("string")), ",")
    return rows.groupBy("norm", F.col("segment").alias("run")).agg(F.min("kind").alias("kind"), F.count(F.lit(1)).alias("n"), ids.alias("ids"))


@query("quotation_depth", f"""{with_views('log')}
SELECT norm, id, CAST(sum(CASE kind WHEN 'signup' THEN 1 WHEN 'error' THEN -1 ELSE 0 END) OVER (PARTITION BY norm ORDER BY day, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM log""")
def quotation_depth(spark, sf_dir):
    """Opened less closed quotations up to each paragraph."""
    delta = F.when(F.col("kind") == "signup", 1).when(F.col("kind") == "error", -1).otherwise(0)
    return views.log(spark, sf_dir).select("norm", "id", F.sum(delta).over(s.running(["norm"], ["day", "id"])).alias("depth"))


@query("heading_levels", f"""{with_views('ver')},
l AS (SELECT DISTINCT norm, block FROM ver)
SELECT norm, block, dense_rank() OVER (PARTITION BY norm ORDER BY block) AS level FROM l""")
def heading_levels(spark, sf_dir):
    """Heading depths that a document uses, renumbered without holes."""
    present = F.array_sort(F.collect_set("block"))
    rows = views.versions(spark, sf_dir).groupBy("norm").agg(present.alias("levels"))
    return rows.select("norm", "levels", F.explode("levels").alias("block")).select("norm", "block", F.array_position("levels", F.col("block")).alias("level"))


@query("segment_blocks", """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
g AS (SELECT doc_id, i, line, sum(CASE WHEN length(line) < 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS segment FROM l)
SELECT doc_id, CAST(segment AS BIGINT) AS segment, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM g GROUP BY doc_id, segment""")
def segment_blocks(spark, sf_dir):
    """A short line heads the block of the lines after it."""
    lines = views.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    rows = s.segment(lines, ["doc_id"], ["i"], F.length("line") < 40)
    return rows.groupBy("doc_id", "segment").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query("continuation_notes", f"""{with_views('log')}
SELECT norm, id, last_value(CASE WHEN value > 50 THEN id END IGNORE NULLS) OVER (PARTITION BY norm ORDER BY day, id ROWS UNBOUNDED PRECEDING) AS note FROM log""")
def continuation_notes(spark, sf_dir):
    note = F.last(F.when(F.col("value") > 50, F.col("id")), ignorenulls=True).over(s.running(["norm"], ["day", "id"]))
    return views.log(spark, sf_dir).select("norm", "id", note.alias("note"))


@query("running_misses", f"""{with_views('log')},
o AS (SELECT norm, id, kind <> 'purchase' AS miss, row_number() OVER (PARTITION BY norm ORDER BY day, id) AS k FROM log),
g AS (SELECT *, k - sum(CAST(miss AS INT)) OVER (PARTITION BY norm ORDER BY k ROWS UNBOUNDED PRECEDING) AS island FROM o),
r AS (SELECT norm, id, k, miss, row_number() OVER (PARTITION BY norm, island, miss ORDER BY k) AS run FROM g),
c AS (SELECT norm, min(k) FILTER (WHERE miss AND run >= 5) AS stop FROM r GROUP BY norm)
SELECT r.norm, count(*) FILTER (WHERE NOT miss) AS found, any_value(stop) AS stop FROM r JOIN c ON r.norm = c.norm WHERE stop IS NULL OR k <= stop GROUP BY r.norm""")
def running_misses(spark, sf_dir):
    """Probe numbers in order and stop at the fifth miss in a row; windows instead of a loop."""
    chain = Window.partitionBy("norm").orderBy("day", "id")
    rows = views.log(spark, sf_dir).select("norm", (F.col("kind") != "purchase").alias("miss"), F.row_number().over(chain).cast("bigint").alias("k"))
    hits = F.sum((~F.col("miss")).cast("int")).over(s.running(["norm"], ["k"]))
    runs = rows.withColumn("island", hits).withColumn("run", F.row_number().over(Window.partitionBy("norm", "island", "miss").orderBy("k")))
    stop = F.min(F.when(F.col("miss") & (F.col("run") >= 5), F.col("k"))).over(Window.partitionBy("norm"))
    return runs.withColumn("stop", stop).where("stop IS NULL OR k <= stop").groupBy("norm").agg(F.count_if(~F.col("miss")).alias("found"), F.max("stop").alias("stop"))


@query("visual_lines")
def visual_lines(spark, sf_dir):
    """Words to lines: a word within the tolerance of its line's first word belongs to that line.

    The anchor of a line depends on where the line before it ended, so this is a fold over the
    words of one page; pages are the groups and fit in memory.
    """
    importable(spark)
    words = views.versions(spark, sf_dir).select("norm", F.col("src").alias("word"), (F.col("qty") * 1.0).alias("top"), F.col("block").alias("x"))

    def lines(page: pd.DataFrame) -> pd.DataFrame:
        page = page.sort_values(["top", "x", "word"])
        anchor, line, out = None, 0, []
        for top in page["top"]:
            if anchor is None or top - anchor > 3.0:
                anchor, line = top, line + 1
            out.append(line)
        return page.assign(line=out)[["norm", "word", "line"]]

    return words.groupBy("norm").applyInPandas(lines, "norm long, word long, line long")


@query("hyphen_merge", r"""SELECT doc_id, md5(regexp_replace(replace(text, '. ', '-' || chr(10)), '([^ ])-' || chr(10), '\1', 'g')) AS merged FROM documents""")
def hyphen_merge(spark, sf_dir):
    """Words broken over lines by a hyphen are joined again."""
    broken = F.replace("text", F.lit(". "), F.lit("-\n"))
    return views.table(spark, sf_dir, "documents").select("doc_id", F.md5(F.regexp_replace(broken, "([^ ])-\n", "$1")).alias("merged"))


@query("annotation_assembly", r"""SELECT page_id, len(regexp_extract_all(html, '<p>[^<]*</p>')) AS n, md5(array_to_string(regexp_extract_all(html, '<p>[^<]*</p>'), '|')) AS notes FROM pages""")
def annotation_assembly(spark, sf_dir):
    """Delimited notes that may run over lines, gathered whole."""
    notes = F.regexp_extract_all("html", F.lit("<p>[^<]*</p>"), 0)
    return views.table(spark, sf_dir, "pages").select("page_id", F.size(notes).cast("bigint").alias("n"), F.md5(F.array_join(notes, "|")).alias("notes"))
