"""Secrets, told apart by corpus-wide ownership, in DataFrame operations only.

Candidates are found by fixed patterns in whole texts. Each candidate value is
hashed and the hashes are aggregated over the corpus by distinct repositories
and owners: a value that several owners carry (EXAMPLE_OWNERS) or many
repositories (EXAMPLE_REPOS) is a widely copied example, any other looks like a
live credential. Ownership decides which of the generic candidates (long mixed
tokens) are added to the base findings: those that look live and that one owner
alone carries; and which findings are redacted: those that look live.

Only found matches are shuffled, and for redaction the rows that have any.
Values are pre-aggregated by (value, owner, repository) before their shuffles,
so a value copied into a third of all rows is a few rows per task; hot values
are joined back by a broadcast. A text's findings are swept in order of their
start, by windows; a text is redacted from blocks of BLOCK characters, so that
the time grows with its length and its findings, not with their product.

Defined cases: a null text is empty; a null owner is one owner of its own, a
null repository one repository; a text without findings has an empty list and
the digest of the empty string; very long texts are scanned and redacted whole,
a text's findings are one group of a task; findings that overlap are redacted
as one; repeated rows are scanned alike; an empty table gives an empty result;
other columns are unused and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, hot_join

# The patterns of the base kinds, in the order that breaks ties
# of the start, with the group that holds the value and the least lengths.
KINDS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               1, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
GENERIC = ("generic", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}", 0, 20)
EXAMPLE_OWNERS = 3           # carried by so many owners: a copied example
EXAMPLE_REPOS = 10           # or by so many repositories
BLOCK = 1 << 16              # characters
MARK = "[SECRET]"


def _matches(text: Column, kind: str, pattern: str, group: int) -> Column:
    """All leftmost non-overlapping matches as (kind, i, gap, size, value):
    the code points since the last match's end and of the match."""
    p = F.lit(pattern)
    found = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(F.regexp_extract_all(text, p, F.lit(0))))
                         .alias("gap"),
                         F.regexp_extract_all(text, p, F.lit(0)).alias("whole"),
                         F.regexp_extract_all(text, p, F.lit(group)).alias("value"))
    rows = F.transform(found, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.char_length(x["gap"]).cast("long").alias("gap"),
        F.char_length(x["whole"]).cast("long").alias("size"), x["value"].alias("value")))
    none = F.array().cast("array<struct<kind:string,i:int,gap:bigint,size:bigint,value:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def candidates(docs: DataFrame, text_col: str, owner_col: str, repo_col: str,
               keep: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): a narrow written table with a row id per input row, and
    (uid, kind, start, end, value, owner, repo) per candidate. ``keep`` maps
    output names to input columns to carry."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = [(k, p, g) for k, (p, g, _) in KINDS.items()] + [GENERIC[:3]]
    rows = cut(docs.select(
        *[F.col(c).alias(f"_k_{o}") for o, c in keep.items()], F.col(owner_col).alias("_owner"),
        F.col(repo_col).alias("_repo"), F.concat(*[_matches(text, *k) for k in kinds]).alias("_found"))
        .withColumn("uid", F.monotonically_increasing_id()), "secret-rows")
    hits = rows.where(F.size("_found") > 0).select("uid", "_owner", "_repo",
                                                   F.explode("_found").alias("m")) \
        .select("uid", F.col("_owner").alias("owner"), F.col("_repo").alias("repo"), "m.*")
    inside = Window.partitionBy("uid", "kind").orderBy("i")
    least = F.create_map(*[F.lit(x) for k, (_, _, n) in [*KINDS.items(), (GENERIC[0], GENERIC[1:])]
                           for x in (k, n)])
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    spans = hits.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(inside)) \
        .withColumn("start", F.col("end") - F.col("size")) \
        .where((F.char_length("value") >= least[F.col("kind")])
               & ((F.col("kind") != GENERIC[0]) | mixed)) \
        .select("uid", "kind", "start", "end", "value", "owner", "repo")
    return rows, cut(spans, "secret-spans")


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos, n_found) per distinct value."""
    per = spans.groupBy(F.sha2("value", 256).alias("hash"), "owner", "repo").agg(
        F.count("*").alias("n"))
    by_repo = per.groupBy("hash", "repo").agg(F.sum("n").alias("n")) \
        .groupBy("hash").agg(F.count("*").alias("n_repos"), F.sum("n").alias("n_found"))
    by_owner = per.groupBy("hash", "owner").agg(F.lit(1).alias("_")) \
        .groupBy("hash").agg(F.count("*").alias("n_owners"))
    return by_owner.join(by_repo, "hash")


def scan(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
         keep: dict[str, str] | None = None, example_owners: int = EXAMPLE_OWNERS,
         example_repos: int = EXAMPLE_REPOS, blocks_of: str | None = None) -> DataFrame:
    """One row per input row: the columns of ``keep``, ``found``, an array of
    (start, ord, kind, end, live, n_owners, n_repos, since) in order of start,
    then kind. Base findings all stay; a generic candidate is added as kind
    ``owned`` if it looks live, only one owner carries it and it touches no base
    finding. ``since`` is, for a live finding that overlaps no live one before
    it, where those before it end (0 if there is none), else null. ``blocks_of``
    names a kept text whose rows with findings have ``blocks`` of it instead."""
    keep = {"doc_id": "doc_id"} if keep is None else keep
    rows, spans = candidates(docs, text_col, owner_col, repo_col, keep)
    spans = spans.withColumn("hash", F.sha2("value", 256))
    known = hot_join(spans.select("uid", "kind", "start", "end", "hash"), cut(ownership(spans), "secret-owners"),
                     ["hash"], "n_found", F.xxhash64("uid", "start"))
    order = F.create_map(*[F.lit(x) for i, k in enumerate([*KINDS, GENERIC[0]]) for x in (k, i)])
    live = (F.col("n_owners") < example_owners) & (F.col("n_repos") < example_repos)
    known = known.withColumn("ord", order[F.col("kind")]).withColumn("live", live)
    # base findings that begin before a generic one, or with it, end before it;
    # those after it begin after its end
    base = F.col("kind") != GENERIC[0]
    text = Window.partitionBy("uid")
    upto = (Window.unboundedPreceding, Window.currentRow)
    before = F.max(F.when(base, F.col("end"))).over(text.orderBy("start").rangeBetween(*upto))
    after = F.min(F.when(base, F.col("start"))).over(text.orderBy(F.col("start").desc()).rangeBetween(*upto))
    known = known.withColumn("_before", before).withColumn("_after", after)
    free = F.coalesce(F.col("_before") <= F.col("start"), F.lit(True)) \
        & F.coalesce(F.col("_after") >= F.col("end"), F.lit(True))
    kept = known.where(base | ((F.col("n_owners") == 1) & F.col("live") & free)).withColumn(
        "kind", F.when(base, F.col("kind")).otherwise(F.lit("owned")))
    done = F.coalesce(F.max(F.when(F.col("live"), F.col("end"))).over(
        text.orderBy("start", "ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    kept = kept.withColumn("_done", done).withColumn(
        "since", F.when(F.col("live") & (F.col("start") >= F.col("_done")), F.col("_done")))
    item = F.struct("start", "ord", "kind", "end", "live", "n_owners", "n_repos", "since")
    per = kept.groupBy("uid").agg(F.sort_array(F.collect_list(item)).alias("found"))
    none = F.array().cast(per.schema["found"].dataType).alias("found")
    cut_up = F.regexp_extract_all(f"_k_{blocks_of}", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    no_blocks = F.lit(None).cast("array<string>")
    kept_cols = [F.col(f"_k_{o}").alias(o) for o in keep]
    # only rows with a candidate are shuffled to their findings
    hit = rows.where(F.size("_found") > 0).drop("_found")
    if blocks_of:
        hit = hit.withColumn("blocks", cut_up).withColumn(f"_k_{blocks_of}", F.lit(None).cast("string"))
    else:
        hit = hit.withColumn("blocks", no_blocks)
    hit = hit.join(per.hint("merge"), "uid", "left") \
        .select(*kept_cols, "blocks", F.coalesce("found", none).alias("found"))
    out = hit.unionByName(rows.where(F.size("_found") == 0).select(*kept_cols, no_blocks.alias("blocks"), none))
    return out if blocks_of else out.drop("blocks")


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(docs: DataFrame, **kw) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live,
    n_example) per row: counts of base findings, all spans, and how many
    findings look live or copied."""
    base = F.filter("found", lambda x: x["kind"] != "owned")
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    return scan(docs, **kw).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda x: x["live"])).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda x: ~x["live"])).cast("long").alias("n_example"))


def _piece(blocks: Column, begin: Column, end: Column) -> Column:
    """Characters begin to end (exclusive) of a text in blocks."""
    first, last = F.floor(begin / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    off, to = (begin % BLOCK).cast("int"), (end % BLOCK).cast("int")
    inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return F.when(first == last, F.coalesce(F.get(blocks, first).substr(off + 1, to - off), F.lit(""))).otherwise(
        F.concat(F.coalesce(F.get(blocks, first).substr(off + 1, F.lit(BLOCK)), F.lit("")), inner,
                 F.coalesce(F.get(blocks, last).substr(F.lit(1), to), F.lit(""))))


def redact(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
           mark: str = MARK, example_owners: int = EXAMPLE_OWNERS,
           example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """``docs`` with every live-looking finding replaced by ``mark`` (findings
    that overlap by one); copied examples and all other text stay, and so does
    every row."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    own = names[text_col]
    found = scan(docs, text_col, owner_col, repo_col, {o: c for c, o in names.items()}, example_owners,
                 example_repos, own)
    blocks, cuts = F.col("blocks"), F.filter("found", lambda x: x["since"].isNotNull())
    ends = F.array_max(F.transform(F.filter("found", lambda x: x["live"]), lambda x: x["end"]))
    size = (F.size(blocks) - 1) * F.lit(BLOCK).cast("long") + F.char_length(F.element_at(blocks, -1))
    done = F.concat(F.array_join(F.transform(cuts, lambda x: _piece(blocks, x["since"], x["start"])), mark),
                    F.lit(mark), _piece(blocks, ends, size))
    new = F.when(blocks.isNull(), F.col(own)).when(F.size(cuts) > 0, done).otherwise(F.array_join(blocks, ""))
    return found.select(*[(new if c == text_col else F.col(o)).alias(c) for c, o in names.items()])
