"""Provider listings read from landed JSON pages, one page per line.

Each scan explodes the pages and applies the provider's own filters to the listing, before any
content is joined. All pages of a listing are read as one multi-file scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import classify as c
from tributary.session import materialize

TREE = "tree array<struct<type:string,path:string,sha:string,size:bigint>>"
TREE_PAGED = "type string, path string, id string, name string, mode string"
DIRS = "values array<struct<type:string,path:string,size:bigint,commit:struct<hash:string>>>, next string"
DRIVE = (
    "nextPageToken string, files array<struct<id:string,name:string,mimeType:string,size:string,"
    "modifiedTime:string,parents:array<string>,webViewLink:string,trashed:boolean,ownedByMe:boolean>>"
)
FOLDER = (
    "entries array<struct<`.tag`:string,id:string,name:string,path_display:string,size:bigint,rev:string,"
    "content_hash:string,server_modified:string>>, has_more boolean, cursor string"
)
FOLDER_TREE = (
    "value array<struct<id:string,name:string,size:bigint,file:struct<mimeType:string>,"
    "folder:struct<childCount:bigint>,parentReference:struct<id:string>,lastModifiedDateTime:string>>,"
    " `@odata.nextLink` string"
)


@dataclass
class SyncOptions:
    """Filter options of a source; empty means no filter."""

    include: list[str] = field(default_factory=list)
    exclude: list[str] = field(default_factory=list)
    max_mb: float | None = None
    include_mimes: list[str] = field(default_factory=list)


def read_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _metadata(**items: Column) -> Column:
    return F.create_map(*[x for k, v in items.items() for x in (F.lit(k), v)]).alias("metadata")


def _repo_kept(path: Column, size: Column | None, o: SyncOptions) -> Column:
    return c.not_binary_repo(c.file_extension(path)) & c.sync_filter_repo(path, size, o.include, o.exclude, o.max_mb)


def _folder_kept(path: Column, name: Column, size: Column, o: SyncOptions) -> Column:
    return c.not_binary_office(c.file_extension(name)) & c.sync_filter_folder(
        path, size, o.include, o.exclude, o.max_mb
    )


def scan_repo_tree(pages: DataFrame, repository: str, branch: str = "main", options: SyncOptions = SyncOptions()) -> DataFrame:
    """One row per blob of a recursive tree response."""
    n = pages.select(F.explode("tree").alias("n")).select("n.*")
    kept = n.where(c.only_files(F.col("type")) & _repo_kept(F.col("path"), F.col("size"), options))
    return kept.select(
        F.col("sha").alias("id"), c.file_name(F.col("path")).alias("name"), "path", F.lit("file").alias("item_type"),
        F.coalesce("size", F.lit(0)).alias("size"),
        _metadata(sha=F.col("sha"), repository=F.lit(repository), branch=F.lit(branch)),
    )


def scan_repo_tree_paged(nodes: DataFrame, project: str, branch: str = "main", options: SyncOptions = SyncOptions()) -> DataFrame:
    """The same over pages that are arrays of nodes; sizes are not listed, so no size filter applies."""
    kept = nodes.where(c.only_files(F.col("type")) & _repo_kept(F.col("path"), None, options))
    return kept.select(
        "id", "name", "path", F.lit("file").alias("item_type"), F.lit(None).cast("long").alias("size"),
        _metadata(sha=F.col("id"), project=F.lit(project), branch=F.lit(branch), mode=F.col("mode")),
    )


def scan_repo_dirs(pages: DataFrame, workspace: str, repo: str, branch: str = "main", options: SyncOptions = SyncOptions()) -> DataFrame:
    """Directory pages: every directory lands its own pages, so only the file entries are kept."""
    n = pages.select(F.explode("values").alias("n")).select("n.*")
    kept = n.where(c.only_files(F.col("type")) & _repo_kept(F.col("path"), F.col("size"), options))
    return kept.select(
        F.coalesce("commit.hash", "path").alias("id"), c.file_name(F.col("path")).alias("name"), "path",
        F.lit("file").alias("item_type"), F.coalesce("size", F.lit(0)).alias("size"),
        _metadata(workspace=F.lit(workspace), repo=F.lit(repo), branch=F.lit(branch)),
    )


def scan_drive_listing(
    pages: DataFrame, folder_id: str | None = None, include_shared: bool = True, options: SyncOptions = SyncOptions()
) -> DataFrame:
    """File pages under the listing predicate, newest first."""
    n = pages.select(F.explode("files").alias("n")).select("n.*")
    size = F.nullif(F.col("size").cast("long"), F.lit(0).cast("long"))
    mime = F.coalesce("mimeType", F.lit(""))
    predicate = c.drive_predicate(
        F.coalesce("trashed", F.lit(False)), mime, F.col("parents"), F.coalesce("ownedByMe", F.lit(False)), folder_id,
        include_shared,
    )
    kept = n.where(
        predicate & c.not_skipped_mime(mime) & c.sync_filter_mime(mime, size, options.include_mimes, options.max_mb)
    )
    return kept.select(
        "id", "name", F.col("name").alias("path"), F.lit("file").alias("item_type"), size.alias("size"),
        mime.alias("mime_type"), F.col("modifiedTime").alias("modified_time"), "parents",
        F.col("webViewLink").alias("web_link"),
    ).orderBy(F.desc("modified_time"))


def scan_folder_listing(pages: DataFrame, options: SyncOptions = SyncOptions()) -> DataFrame:
    """Recursive folder pages; only entries tagged as files."""
    n = pages.select(F.explode("entries").alias("n")).select("n.*")
    path = F.col("path_display")
    kept = n.where(c.only_files(F.col("`.tag`")) & _folder_kept(path, path, F.col("size"), options))
    return kept.select(
        "id", "name", path.alias("path"), F.lit("file").alias("item_type"), F.coalesce("size", F.lit(0)).alias("size"),
        _metadata(rev=F.col("rev"), content_hash=F.col("content_hash"), server_modified=F.col("server_modified")),
    )


def folder_paths(folders: DataFrame) -> DataFrame:
    """Full path of every folder (id, parent_id, name) reachable from the root (parent_id null).

    Each round joins a folder to the folder it points to and jumps over it, so a tree of depth d takes
    log2(d) rounds; folders are far fewer than files. A folder that is listed twice counts once. Folders on a
    cycle of parents, or below one or below a folder that is not listed, are not reachable and have no path: after
    r rounds every folder of a depth below 2**r has its path, so a round that settles none is the last.
    """
    links = materialize(folders.groupBy("id").agg(F.min(F.struct("parent_id", "name")).alias("f")).select("id", "f.*"), "folders")
    up = links.select("id", F.col("parent_id").alias("up"))
    # depths first, on ids alone: what a cycle holds never grows a path
    reached = up.where("up is null").select("id", F.lit(0).cast("long").alias("depth"))
    open_ = up.where("up is not null").withColumn("jump", F.lit(1).cast("long"))
    while True:
        now = open_.select("id", "up", "jump")
        there = reached.select(F.col("id").alias("_id"), "depth")
        settled = materialize(now.join(there, F.col("up") == F.col("_id")).select("id", (F.col("depth") + F.col("jump")).alias("depth")), "reached")
        if settled.isEmpty():
            break
        reached = reached.unionByName(settled)
        left = now.join(settled.select("id"), "id", "left_anti")
        over = left.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("jump").alias("_jump"))
        # an open folder jumps over the open one it points to; one that points to a settled one is settled next
        jumped = left.join(over, F.col("up") == F.col("_id"), "left").select(
            "id", F.coalesce("_up", "up").alias("up"), (F.col("jump") + F.coalesce("_jump", F.lit(0))).alias("jump")
        )
        open_ = materialize(jumped, "open")
    safe = links.join(reached.select("id"), "id")
    paths = materialize(safe.select("id", F.col("parent_id").alias("up"), F.col("name").alias("path")), "folders")
    while not paths.where("up is not null").isEmpty():
        over = paths.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        jumped = paths.where("up is not null").join(over, F.col("up") == F.col("_id")).select(
            "id", F.col("_up").alias("up"), F.concat_ws("/", "_path", "path").alias("path")
        )
        paths = materialize(paths.where("up is null").unionByName(jumped), "folders")
    return paths.select("id", "path")


def scan_folder_tree(pages: DataFrame, root_id: str = "root", options: SyncOptions = SyncOptions()) -> DataFrame:
    """Children pages of every folder; paths are built from the parent references."""
    n = pages.select(F.explode("value").alias("n")).select("n.*").withColumn(
        "parent_id", F.nullif(F.col("parentReference.id"), F.lit(root_id))
    )
    folders = folder_paths(n.where("folder is not null").select("id", "parent_id", "name"))
    files = n.where("folder is null and file is not null")
    placed = files.join(folders.select(F.col("id").alias("_fid"), F.col("path").alias("_dir")), F.col("parent_id") == F.col("_fid"), "left")
    rows = placed.where("parent_id is null or _dir is not null").withColumn("path", F.concat_ws("/", "_dir", "name"))
    kept = rows.where(_folder_kept(F.col("path"), F.col("name"), F.col("size"), options))
    return kept.select(
        "id", "name", "path", F.lit("file").alias("item_type"), F.coalesce("size", F.lit(0)).alias("size"),
        _metadata(mime_type=F.col("file.mimeType"), modified_time=F.col("lastModifiedDateTime")),
    )
