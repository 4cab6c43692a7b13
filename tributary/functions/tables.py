"""Fixed values. Results depend on every entry, so they are stated plainly."""

# fixed values: content type by extension, repositories and local files
CONTENT_TYPES = {
    "md": "markdown", "markdown": "markdown", "html": "html", "htm": "html", "json": "json", "xml": "xml",
    "yaml": "yaml", "yml": "yaml", "txt": "text",
}

# fixed values: extensions that count as code when no content type is listed
CODE_EXTENSIONS = [
    "rs", "py", "js", "ts", "go", "java", "c", "cpp", "h", "hpp", "cs", "rb", "php", "swift", "kt", "scala", "sql",
    "sh", "bash", "ps1", "psm1", "jsx", "tsx", "vue", "svelte", "css", "scss", "sass",
]

# fixed values: content type by extension, Dropbox
DROPBOX_TYPES = {
    "md": "markdown", "markdown": "markdown", "txt": "text", "html": "html", "htm": "html", "json": "json",
    "xml": "xml", "yaml": "yaml", "yml": "yaml", "csv": "spreadsheet", "pdf": "pdf", "doc": "document",
    "docx": "document",
}

# fixed values: OneDrive knows four more office formats
ONEDRIVE_TYPES = {
    **DROPBOX_TYPES, "xls": "spreadsheet", "xlsx": "spreadsheet", "ppt": "presentation", "pptx": "presentation",
}

# fixed values: content type by media type
MIME_TYPES = {
    "application/vnd.google-apps.document": "document",
    "application/vnd.google-apps.spreadsheet": "spreadsheet",
    "application/vnd.google-apps.presentation": "presentation",
    "text/plain": "text", "text/markdown": "markdown", "text/html": "html", "application/json": "json",
    "application/xml": "xml", "text/xml": "xml", "application/pdf": "pdf", "text/x-python": "code",
    "text/javascript": "code", "application/x-javascript": "code", "text/x-java-source": "code",
}

# fixed values: media types that native documents are exported to
EXPORT_MIMES = {
    "application/vnd.google-apps.document": "text/plain",
    "application/vnd.google-apps.spreadsheet": "text/csv",
    "application/vnd.google-apps.presentation": "text/plain",
}

# fixed values: media type prefixes that are never fetched
SKIP_MIMES = [
    "image/", "video/", "audio/", "application/zip", "application/x-rar-compressed", "application/x-7z-compressed",
    "application/octet-stream",
]

FOLDER_MIME = "application/vnd.google-apps.folder"

# fixed values: extensions skipped by repositories and local files
BINARY_REPO = [
    "png", "jpg", "jpeg", "gif", "ico", "svg", "webp", "bmp", "woff", "woff2", "ttf", "eot", "otf", "pdf", "doc",
    "docx", "xls", "xlsx", "ppt", "pptx", "zip", "tar", "gz", "rar", "7z", "exe", "dll", "so", "dylib", "bin", "mp3",
    "mp4", "wav", "avi", "mov", "mkv", "db", "sqlite", "lock",
]

# fixed values: office sources keep pdf, office and lock files
BINARY_OFFICE = [
    "png", "jpg", "jpeg", "gif", "ico", "svg", "webp", "bmp", "woff", "woff2", "ttf", "eot", "otf", "zip", "tar",
    "gz", "rar", "7z", "exe", "dll", "so", "dylib", "bin", "mp3", "mp4", "wav", "avi", "mov", "mkv", "db", "sqlite",
]

# fixed values: language by extension
LANGUAGES = {
    "rs": "rust", "py": "python", "js": "javascript", "ts": "typescript", "jsx": "javascript", "tsx": "typescript",
    "go": "go", "java": "java", "c": "c", "cpp": "cpp", "cc": "cpp", "cxx": "cpp", "h": "c", "hpp": "c",
    "cs": "csharp", "rb": "ruby", "php": "php", "swift": "swift", "kt": "kotlin", "scala": "scala", "sql": "sql",
    "sh": "shell", "bash": "shell", "ps1": "powershell", "psm1": "powershell", "vue": "vue", "svelte": "svelte",
    "md": "markdown", "markdown": "markdown", "json": "json", "yaml": "yaml", "yml": "yaml", "xml": "xml",
    "html": "html", "htm": "html", "css": "css", "scss": "scss", "sass": "scss",
}

# fixed values: Bitbucket's own list
BITBUCKET_LANGUAGES = {
    "rs": "rust", "py": "python", "js": "javascript", "ts": "typescript", "jsx": "javascript", "tsx": "typescript",
    "go": "go", "java": "java", "c": "c", "cpp": "cpp", "h": "c", "hpp": "cpp", "cs": "csharp", "rb": "ruby",
    "php": "php", "swift": "swift", "kt": "kotlin", "scala": "scala", "sql": "sql", "sh": "shell", "bash": "shell",
    "vue": "vue", "svelte": "svelte", "md": "markdown",
}

# local files know no cc, cxx and sass
LOCAL_LANGUAGES = {ext: lang for ext, lang in LANGUAGES.items() if ext not in ("cc", "cxx", "sass")}

# fixed values: kind of source by connector type
SOURCE_KINDS = {
    "github": "code_repo", "gitlab": "code_repo", "bitbucket": "code_repo", "local_file": "document",
    "google_drive": "document", "dropbox": "document", "onedrive": "document", "slack": "chat", "notion": "wiki",
    "confluence": "wiki", "url_scraper": "web",
}

GIT_TYPES = ["github", "gitlab", "bitbucket"]
WIKI_TYPES = ["notion", "confluence"]

# fixed values: exclude globs applied to every source by default
DEFAULT_EXCLUDES = [
    "node_modules/**", "vendor/**", ".git/**", "__pycache__/**", ".venv/**", "target/**", "dist/**", "build/**",
    "*.min.js", "*.min.css", "*.bundle.js", "*.map", "*.lock", "package-lock.json", "yarn.lock", "Cargo.lock",
    "*.png", "*.jpg", "*.gif", "*.ico", "*.pdf", "*.zip", "*.tar.gz", "*.exe", "*.dll", "*.so",
]

# fixed values: message types by transport
KAFKA_TYPES = ["file.ingested", "code.normalized", "chunk.created", "embedding.generated", "graph.updated"]
RABBIT_TYPES = [
    "webhook.github", "webhook.gitlab", "auth.verify", "auth.session", "notification.email", "notification.slack",
    "sync.scheduled", "sync.manual",
]

# fixed values: allowed values of enumerated columns
DOMAINS = {
    "connector_type": list(SOURCE_KINDS),
    "content_type": [
        "text", "code", "markdown", "html", "json", "xml", "yaml", "binary", "unknown", "document", "spreadsheet",
        "presentation", "pdf",
    ],
    "source_kind": ["code_repo", "document", "chat", "ticketing", "wiki", "email", "web", "other"],
    "sync_type": ["full", "incremental", "webhook"],
    "job_status": ["pending", "running", "completed", "failed"],
    "connector_status": ["active", "syncing", "disabled", "error"],
    "priority": ["low", "normal", "high"],
}

# fixed values: priority bands, most urgent first, with inclusive bounds
BANDS = {"critical": (0, 2), "high": (3, 4), "normal": (5, 6), "low": (7, 9)}
