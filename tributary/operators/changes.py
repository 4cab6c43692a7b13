"""Provider webhooks as change events (item_id, change_type, cursor)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the fields that are read from each payload
PUSH = "object_kind string, commits array<struct<id:string,added:array<string>,modified:array<string>,removed:array<string>>>"
BITBUCKET = "push struct<changes:array<struct<commits:array<struct<hash:string>>>>>"
DRIVE = "resourceId string, resource_id string"
DROPBOX = "delta struct<users:array<string>>"
ONEDRIVE = "value array<struct<resource:string,changeType:string,subscriptionId:string>>"


def _parsed(webhooks: DataFrame, schema: str, payload: str) -> tuple[DataFrame, list[str]]:
    keep = [x for x in webhooks.columns if x != payload]
    return webhooks.withColumn("_p", F.from_json(F.col(payload), schema)), keep


def _paths(paths: Column, change: str, cursor: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.transform(
        F.coalesce(paths, none),
        lambda p: F.struct(p.alias("item_id"), F.lit(change).alias("change_type"), cursor.alias("cursor")),
    )


def _ordered(rows: DataFrame, array: str | Column, keep: list, at: str, element: str) -> DataFrame:
    """Elements of an array with their number."""
    return rows.select(*keep, F.posexplode(array).alias(at, element))


def changes_github(webhooks: DataFrame, payload: str = "payload") -> DataFrame:
    """Added, modified and removed paths of every commit of a push, numbered by (commit_no, position) in their order."""
    p, keep = _parsed(webhooks, PUSH, payload)
    commits = _ordered(p, "_p.commits", keep, "commit_no", "c")
    cursor = F.col("c.id")
    all_paths = F.concat(
        _paths(F.col("c.added"), "created", cursor), _paths(F.col("c.modified"), "updated", cursor),
        _paths(F.col("c.removed"), "deleted", cursor),
    )
    return _ordered(commits, all_paths, [*keep, "commit_no"], "position", "e").select(*keep, "e.*", "commit_no", "position")


def changes_gitlab(webhooks: DataFrame, payload: str = "payload") -> DataFrame:
    """The same, for push events only."""
    pushes = webhooks.where(F.get_json_object(F.col(payload), "$.object_kind") == "push")
    return changes_github(pushes, payload)


def changes_bitbucket(webhooks: DataFrame, payload: str = "payload") -> DataFrame:
    """Pushed commits by hash; the payload lists no files."""
    p, keep = _parsed(webhooks, BITBUCKET, payload)
    changes = p.select(*keep, F.explode("_p.push.changes").alias("c"))
    sha = F.coalesce("h.hash", F.lit(""))
    return changes.select(*keep, F.explode("c.commits").alias("h")).select(
        *keep, sha.alias("item_id"), F.lit("updated").alias("change_type"), sha.alias("cursor")
    )


def changes_drive(webhooks: DataFrame, payload: str = "payload") -> DataFrame:
    p, keep = _parsed(webhooks, DRIVE, payload)
    item = F.coalesce(F.nullif("_p.resourceId", F.lit("")), F.nullif("_p.resource_id", F.lit("")))
    return p.select(
        *keep, item.alias("item_id"), F.lit("updated").alias("change_type"), F.lit(None).cast("string").alias("cursor")
    ).where("item_id is not null")


def changes_dropbox(webhooks: DataFrame, payload: str = "payload") -> DataFrame:
    p, keep = _parsed(webhooks, DROPBOX, payload)
    return p.select(*keep, F.explode("_p.delta.users").alias("item_id")).select(
        *keep, "item_id", F.lit("updated").alias("change_type"), F.lit(None).cast("string").alias("cursor")
    )


def changes_onedrive(webhooks: DataFrame, payload: str = "payload") -> DataFrame:
    p, keep = _parsed(webhooks, ONEDRIVE, payload)
    return p.select(*keep, F.explode("_p.value").alias("n")).select(
        *keep, F.coalesce("n.resource", F.lit("")).alias("item_id"),
        F.coalesce("n.changeType", F.lit("updated")).alias("change_type"), F.col("n.subscriptionId").alias("cursor"),
    )


CHANGE = "array<struct<item_id:string,change_type:string,cursor:string,commit_no:int,position:int>>"


def _listed(elements: Column, entry) -> Column:
    """An array of changes from an array and a function of element and number; none without the array."""
    return F.coalesce(F.transform(elements, entry), F.array()).cast(CHANGE)


def _change(item: Column, kind: Column, cursor: Column) -> Column:
    none = F.lit(None).cast("int")
    return F.struct(item.alias("item_id"), kind.alias("change_type"), cursor.cast("string").alias("cursor"), none.alias("commit_no"), none.alias("position"))


def _push_array(payload: Column) -> Column:
    def of_commit(c: Column, n: Column) -> Column:
        cursor = c["id"]
        all_paths = F.concat(_paths(c["added"], "created", cursor), _paths(c["modified"], "updated", cursor), _paths(c["removed"], "deleted", cursor))
        return F.transform(all_paths, lambda e, k: F.struct(e["item_id"].alias("item_id"), e["change_type"].alias("change_type"), e["cursor"].alias("cursor"), n.alias("commit_no"), k.alias("position")))

    return F.coalesce(F.flatten(F.transform(F.from_json(payload, PUSH)["commits"], of_commit)), F.array()).cast(CHANGE)


def change_array(provider: Column, payload: Column) -> Column:
    """The changes of one webhook by its provider's rules, as an array; only the provider's own parser runs on a row."""
    updated, none = F.lit("updated"), F.lit(None)
    nothing = F.array().cast(CHANGE)
    pushed = F.flatten(F.transform(F.from_json(payload, BITBUCKET)["push"]["changes"], lambda c: c["commits"]))
    hashes = F.transform(pushed, lambda h: F.coalesce(h["hash"], F.lit("")))
    drive = F.from_json(payload, DRIVE)
    item = F.coalesce(F.nullif(drive["resourceId"], F.lit("")), F.nullif(drive["resource_id"], F.lit("")))
    users = F.from_json(payload, DROPBOX)["delta"]["users"]
    notes = F.from_json(payload, ONEDRIVE)["value"]
    by_provider = {
        "github": _push_array(payload),
        "gitlab": F.when(F.get_json_object(payload, "$.object_kind") == "push", _push_array(payload)).otherwise(nothing),
        "bitbucket": _listed(hashes, lambda h: _change(h, updated, h)),
        "google_drive": F.when(item.isNotNull(), F.array(_change(item, updated, none)).cast(CHANGE)).otherwise(nothing),
        "dropbox": _listed(users, lambda u: _change(u, updated, none)),
        "onedrive": _listed(notes, lambda n: _change(F.coalesce(n["resource"], F.lit("")), F.coalesce(n["changeType"], updated), n["subscriptionId"])),
    }
    out = None
    for name, found in by_provider.items():
        out = F.when(provider == name, found) if out is None else out.when(provider == name, found)
    return out.otherwise(nothing)


def changes_of(webhooks: DataFrame, provider: str = "provider", payload: str = "payload") -> DataFrame:
    """Changes of every webhook by its provider's rules, in one pass; commit_no and position are null where there are no commits."""
    keep = [c for c in webhooks.columns if c != payload]
    found = webhooks.select(*keep, F.explode(change_array(F.col(provider), F.col(payload))).alias("_e"))
    return found.select(*keep, "_e.*")


def changes_since(changes: DataFrame, cursors: Column | DataFrame) -> DataFrame:
    """Only what came at or after the stored cursor: a time, or a table (source_id, cursor); a source without one starts anew.

    Changes at the cursor's very time are read again, since more of them may have come after it was stored.
    """
    if isinstance(cursors, Column):
        return changes.where(F.col("timestamp") >= cursors)
    stored = cursors.select(F.col("source_id").alias("_source"), F.col("cursor").alias("_cursor"))
    joined = changes.join(stored, F.col("source_id") == F.col("_source"), "left")
    return joined.where(F.col("_cursor").isNull() | (F.col("timestamp") >= F.col("_cursor"))).drop("_source", "_cursor")


def new_cursor(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The cursor to store per source: its newest change."""
    return changes.groupBy(*keys).agg(F.max("timestamp").alias("cursor"))
