"""

``backup_targets`` is the planning side of ``backup [selectors]``: the
configured directory groups (B1) selected by glob (C2), home-expanded (B2),
each given an archive path (B5) that never overwrites: requests that share
a name take the next free slot after the existing archives (D6), and the
upload key follows from the archive (B6).

``deploy_services`` is the data side of ``up`` / ``down [selectors]``: find the
service roots in a file listing (D3), keep those whose name matches any
selector (C2; no selectors keeps all), and attach each service's environment
from the layered overlays (D1).  The start/stop commands themselves are host
control and not built; their result rows are what E1/E2, G1 and F2/F8 read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.functions.paths import archive_name, expand_home, slot_name, upload_key
from opslog.operators.discover import free_slot, marker_roots
from opslog.operators.flatten import explode_groups
from opslog.operators.overlay import env_overlay
from opslog.operators.select import select_by_globs
from opslog.session import materialize


def deploy_services(files: DataFrame, selectors: list[str], overlays: DataFrame,
                    path_col: str = "path") -> DataFrame:
    """``(name, kind, directory, env)`` for every selected service root."""
    # names, matching and the result read the same few roots: the listing is searched once
    roots = materialize(select_by_globs(marker_roots(files, path_col), "name", selectors), "roots")
    env = env_overlay(roots.select("name"), overlays)
    return roots.join(env, "name", "left").select(
        "name", "kind", "directory", F.coalesce("env", F.create_map().cast("map<string,string>")).alias("env"))


def backup_targets(configs: DataFrame, selectors: list[str], dest: str, home: str, run_ts: str,
                   ext: str = "rar", existing: DataFrame | None = None, order=("cfg_id", "pos")) -> DataFrame:
    """``(cfg_id, grp, pos, directory, archive, key)`` for every non-empty selected directory."""
    spark = configs.sparkSession
    dirs = select_by_globs(explode_groups(configs), "grp", selectors)
    dirs = dirs.where(F.length("directory") > 0).withColumn("directory", expand_home("directory", home))
    ts = F.to_timestamp_ntz(F.lit(run_ts))
    req = dirs.withColumn("base", F.regexp_replace(archive_name(dest, "grp", "directory", ts, ext),
                                                   r"\." + ext + "$", ""))
    if existing is None:
        existing = spark.createDataFrame([], "base string, slot bigint")
    slotted = free_slot(req, existing, "base", order)
    archive = F.concat(slot_name("base", "slot"), F.lit("." + ext))
    return slotted.select("cfg_id", "grp", "pos", "directory", archive.alias("archive")) \
                  .withColumn("key", upload_key("grp", "directory", "archive"))
