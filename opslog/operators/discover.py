"""Finding things in listings (operators D3-D6).

D3 finds the roots of marked subtrees: a directory holding a marker file is
a root and nothing below it is searched.  Instead of walking the tree, every
marked directory lists its ancestors (bounded by path depth), an equi
semi-join finds the marked ones that sit under another marked directory, and
an anti-join drops them.  All joins are equi-joins on path strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.paths import base_name, dir_name
from opslog.operators.scan import ordered_scan

# File names that mark a service directory.
COMPOSE_FILES = ["compose.yml", "compose.yaml", "docker-compose.yml", "docker-compose.yaml"]
SERVICE_KIND = "docker-compose"


def ancestors(col) -> Column:
    """Proper ancestors of a ``/``-separated path (``a/b/c`` -> ``a``, ``a/b``)."""
    parts = F.split(F.col(col) if isinstance(col, str) else col, "/")
    n = F.size(parts)
    idx = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def marker_roots(files: DataFrame, path_col: str = "path", markers: list[str] | None = None,
                 kind: str = SERVICE_KIND) -> DataFrame:
    """D3: ``(name, kind, directory)`` for every marked directory not below another marked one."""
    markers = markers or COMPOSE_FILES
    p = F.col(path_col)
    inside = F.when(p.contains("/"), dir_name(p)).otherwise(F.lit(""))  # the listing's root is ''
    marked = files.where(base_name(p).isin(markers)).select(inside.alias("directory")).distinct()
    above = F.array_union(F.array(F.lit("")), ancestors("directory"))
    anc = marked.where("directory <> ''").select("directory", F.explode(above).alias("_anc"))
    shadowed = anc.join(marked.select(F.col("directory").alias("_anc")), "_anc", "left_semi") \
                  .select("directory").distinct()
    roots = marked.join(shadowed, "directory", "left_anti")
    return roots.select(base_name("directory").alias("name"), F.lit(kind).alias("kind"), "directory")


def marker_roots_under(files: DataFrame, given: DataFrame, path_col: str = "path", root_col: str = "root",
                       markers: list[str] | None = None, kind: str = SERVICE_KIND) -> DataFrame:
    """D3 from several given directories: ``(root, name, kind, directory)`` for each root by itself.

    A marked directory belongs to a given root that is itself or an ancestor, unless another marked directory lies on
    the way down to it.  Roots may be nested, overlap or be missing from the listing; '' is the listing's own root, a
    trailing slash says nothing.  Whether something lies on the way is told by depth: the deepest marked ancestor of a
    directory hides it from the roots that are at least as high, so two equi-joins on path prefixes suffice.
    """
    depth = lambda c: F.when(c == "", 0).otherwise(F.size(F.split(c, "/")))
    p = F.col(path_col)
    inside = F.when(p.contains("/"), dir_name(p)).otherwise(F.lit(""))
    marked = files.where(base_name(p).isin(markers or COMPOSE_FILES)).select(inside.alias("directory")).distinct()
    above = F.when(F.col("directory") == "", F.array(F.lit(""))).otherwise(
        F.concat(F.array(F.lit("")), ancestors("directory"), F.array(F.col("directory"))))
    prefixes = marked.select("directory", F.explode(above).alias("_at"))
    hidden = (prefixes.where("_at <> directory").join(marked.select(F.col("directory").alias("_at")), "_at")
              .groupBy("directory").agg(F.max(depth(F.col("_at"))).alias("_hidden")))
    roots = given.select(F.col(root_col).alias("root"), F.rtrim(F.col(root_col), F.lit("/")).alias("_at"))
    found = prefixes.join(roots, "_at").join(hidden, "directory", "left")
    return found.where(F.col("_hidden").isNull() | (F.col("_hidden") < depth(F.col("_at")))).select(
        "root", base_name("directory").alias("name"), F.lit(kind).alias("kind"), "directory")


def entry_exists(entries: DataFrame, listing: DataFrame, path_col: str = "archive",
                 listing_col: str = "path", out: str = "exists") -> DataFrame:
    """Flag entries whose file appears in a listing (left join to the distinct listing)."""
    present = listing.select(F.col(listing_col).alias("_p")).distinct().withColumn("_hit", F.lit(True))
    j = entries.join(present, entries[path_col] == F.col("_p"), "left")
    return j.withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_p", "_hit")


def backup_upload_join(archives: DataFrame, uploads: DataFrame, key: str = "archive") -> DataFrame:
    """Each archive with its upload; both must succeed; no upload row means not attempted."""
    u = uploads.select(*[F.col(c).alias(f"u_{c}") if c != key else F.col(c) for c in uploads.columns])
    j = archives.join(u, key, "left")
    return j.withColumn("attempted", F.col("u_success").isNotNull()) \
            .withColumn("pair_success", F.coalesce(F.col("success") & F.col("u_success"), F.lit(False)))


def free_slot(requests: DataFrame, existing: DataFrame, base_col: str = "base", order_cols=("seq",),
              slot_col: str = "slot") -> DataFrame:
    """The k-th request for a base gets the k-th unused slot number (0 = the base itself).

    Existing slots are ``(base, slot)`` rows.  With existing slots e_1 < e_2 < ...
    the number of free slots below e_j is ``g_j = e_j - (j - 1)``; request r
    (0-based) lands on ``r + j`` where j counts the existing slots with
    ``g_j <= r``.  That count is an as-of lookup, done by one ordered pass over
    requests and existing slots together, so no candidate list is generated;
    requests carry their columns through it.
    """
    ex = existing.select(base_col, F.col(slot_col).cast("bigint").alias("_e")).distinct()
    ex = ordered_scan(ex, base_col, "_e", rn_col="_j0")
    req = ordered_scan(requests, base_col, list(order_cols), rn_col="_r0")
    # events sorted by (position, kind): an existing slot with g_j <= r precedes request r
    row = F.struct(*requests.columns)
    evs = (ex.select(base_col, (F.col("_e") - (F.col("_j0") - 1)).alias("_pos"), F.lit(0).alias("_kind"), "_e",
                     F.lit(1).alias("_cnt"), F.lit(None).cast(requests.select(row).schema[0].dataType).alias("_row"))
           .unionByName(req.select(base_col, (F.col("_r0") - 1).alias("_pos"), F.lit(1).alias("_kind"),
                                   F.lit(0).cast("bigint").alias("_e"), F.lit(0).alias("_cnt"), row.alias("_row"))))
    counted = ordered_scan(evs, base_col, ["_pos", "_kind", "_e"], value="_cnt", cum_col="_j").where(F.col("_kind") == 1)
    return counted.select(*[F.col(f"_row.{c}").alias(c) for c in requests.columns],
                          (F.col("_pos") + F.col("_j")).cast("bigint").alias(slot_col))
