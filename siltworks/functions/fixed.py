"""Lists, patterns and texts that results depend on.  Nothing here is logic.

Patterns use ``\\s`` and ``.`` in their JavaScript sense; regex.py writes them for an engine.
"""

# --- fixed values: plan defaults ---
DEFAULT_LICENSES = ["MIT", "Apache-2.0", "BSD-3-Clause"]
DEFAULT_EXCLUDED_PATHS = ["node_modules", "vendor", "dist", "build", "*.min.js", "*.lock"]
DEFAULT_EXCLUDED_EXTENSIONS = [".png", ".jpg", ".svg", ".woff", ".zip", ".exe", ".bin", ".pdf"]

# --- fixed values: path lists ---
REMOVED_DIRS = [
    "node_modules", "vendor", "dist", "build", "coverage", ".next", ".nuxt", ".git", ".cache", "__pycache__", ".parcel-cache", ".turbo", "out", "target",
]
REMOVED_NAMES = ["*.min.js", "*.min.css", "*.lock", "*.map", "package-lock.json", "yarn.lock", "pnpm-lock.yaml", "tsconfig.tsbuildinfo"]
TEST_DIRS = ["test", "tests", "__tests__", "__snapshots__", "fixture", "fixtures", "spec", "specs"]
KEPT_EXTENSIONS = [".ts", ".tsx", ".js", ".jsx", ".mjs", ".cjs", ".json", ".md"]
DOC_EXTENSIONS = [".md", ".mdx", ".rst", ".txt"]
GENERATED_DIRS = [*REMOVED_DIRS, ".nx"]
GENERATED_ENDINGS = [".min.js", ".min.css", ".lock", ".map", "package-lock.json", "yarn.lock", "pnpm-lock.yaml", ".generated."]
TEST_PARTS = [
    "/test/", "/tests/", "/__tests__/", "/__snapshots__/", "/spec/", "/specs/", ".test.", ".spec.", "-test.", "-spec.", "_test.", "_spec.",
    "/fixture/", "/fixtures/", "/testing/",
]
DOC_PARTS = ["/docs/", "/documentation/", "/examples/", "/example/", "/demo/", "/demos/", "/tutorial/", "/tutorials/", "/guides/", "/recipes/"]
CODE_TEST_PARTS = ["/test/", "/tests/", "/__tests__/", "/spec/", "/specs/"]
CODE_TEST_ENDINGS = [".test.ts", ".test.tsx", ".test.js", ".spec.ts", ".spec.js"]
CODE_EXTENSIONS = [".ts", ".tsx", ".js", ".jsx", ".mjs", ".cjs"]
TYPESCRIPT_EXTENSIONS = [".ts", ".tsx", ".mts", ".cts"]
PROSE_EXTENSIONS = [".md", ".mdx", ".rst"]
CONFIG_EXTENSIONS = [".json", ".yaml", ".yml", ".toml"]
STYLE_EXTENSIONS = [".css", ".scss", ".less", ".html", ".htm"]

# --- fixed values: languages ---
EXTENSION_LANGUAGE = {
    ".ts": "typescript", ".tsx": "typescript", ".js": "javascript", ".jsx": "javascript", ".mjs": "javascript", ".cjs": "javascript",
    ".py": "python", ".go": "go", ".rs": "rust", ".java": "java", ".rb": "ruby", ".php": "php", ".c": "c", ".h": "c", ".cpp": "cpp", ".hpp": "cpp",
    ".cs": "csharp", ".swift": "swift", ".kt": "kotlin", ".scala": "scala", ".r": "r", ".lua": "lua", ".sh": "shell", ".bash": "shell", ".zsh": "shell",
    ".pl": "perl", ".pm": "perl", ".vue": "vue", ".svelte": "svelte", ".astro": "astro",
}
LANGUAGE_ALIASES = {"c++": "cpp", "c#": "csharp"}
LANGUAGE_GROUPS = {
    "TypeScript": [".ts", ".tsx", ".mts", ".cts"],
    "JavaScript": [".js", ".jsx", ".mjs", ".cjs"],
    "Markdown": [".md", ".mdx", ".rst"],
    "JSON": [".json"],
    "CSS/HTML": [".css", ".scss", ".less", ".html", ".htm"],
    "Config": [".yaml", ".yml", ".toml", ".ini", ".cfg", ".xml"],
    "Asset": [".svg", ".png", ".jpg", ".jpeg", ".gif", ".ico", ".woff", ".woff2", ".ttf", ".eot"],
}
TYPE_LANGUAGES = {
    "function_explain": ["TypeScript", "JavaScript"],
    "type_definition": ["TypeScript"],
    "error_context": ["TypeScript"],
    "test_assertion": ["TypeScript", "JavaScript"],
    "error_handling": ["TypeScript", "JavaScript"],
    "file_context": ["TypeScript", "JavaScript"],
    "doc_context": ["Markdown"],
}

# --- fixed values: licence keywords, in order; the first with two hits counts ---
LICENSE_KEYWORDS = [
    ("MIT", ["permission is hereby granted", "the software", "the authors"]),
    ("Apache-2.0", ["apache license", "version 2.0", "apache"]),
    ("BSD-3-Clause", ["redistribution and use", "this list of conditions", "3-clause"]),
    ("BSD-2-Clause", ["redistribution and use", "this list of conditions", "2-clause"]),
    ("GPL-3.0", ["gnu general public license", "version 3"]),
    ("GPL-2.0", ["gnu general public license", "version 2"]),
    ("LGPL-3.0", ["gnu lesser general public license", "version 3"]),
    ("MPL-2.0", ["mozilla public license", "version 2.0"]),
    ("Unlicense", ["this is free and unencumbered software", "public domain"]),
    ("ISC", ["isc license", "permission to use"]),
    ("0BSD", ["zero-clause", "no copyright"]),
]
LICENSE_FILES = ["LICENSE", "LICENSE.md", "LICENSE.txt", "COPYING"]

# --- fixed values: extraction patterns ---
FUNCTION = r"""/\*\*[\s\S]*?\*/\s*(?:export\s+)?(?:async\s+)?function\s+(?:\*\s*)?(\w+)\s*\([\s\S]*?\)\s*(?::\s*[\w<>\[\]|&,\s'"]+)?\s*\{"""
TYPE = r"(?:export\s+)?(?:type|interface)\s+(\w+)(?:\s*<[\s\S]*?>)?(?:\s+extends\s+([\w.\s,]+))?\s*\{([\s\S]*?)\}\s*[;]?"
PROPERTY = r"^\s*(\w+)\s*(\?)?\s*:\s*([^\s;=,]+)"
TS_ERROR = r"//\s*@ts-(?:expect-error|ignore)(?:\s+(.+?))?\n([\s\S]*?)(?=\n\n|\n//|\n\z)"
TEST_BLOCK = r"""(?:describe|it|test)\s*\(\s*["'`](.+?)["'`]\s*,\s*(?:async\s*)?\(?\s*(?:[\w]+\s*)?=>\s*\{[\s\S]*?\}\s*\)\s*\)"""
ERROR_PATTERN = r"(?:try\s*\{[\s\S]*?\}\s*catch\s*\([\s\S]*?\)\s*\{[\s\S]*?\}|throw\s+(?:new\s+)?(\w+(?:Error|Exception))\s*\([^)]*\)[\s\S]{0,200})"
TEST_TITLE = r"""(?:describe|it|test)\s*\(\s*["'`]([^"'`]+)["'`]"""
HEADING = r"(?m)^#\s+(.+)"
PARAGRAPH = r"(?m)^(?:[A-Z][^\n]{10,}?)(?:\.|\n)"
THROWN = r"throw\s+(?:new\s+)?(\w+(?:Error|Exception))"
CAUGHT = r"catch\s*\(\s*(\w+)(?:\s*:\s*(\w+))?"
IMPORTS = r"(?m)^(?:import\s+|const\s+.*?=\s*require\s*\()"
EXPORTS = r"(?m)^(?:export\s+(?:default\s+)?(?:function|class|const|let|var|interface|type|enum|async\s+function))"
FUNCTIONS = r"\b(?:async\s+)?function\s+\w+\s*\("
CLASSES = r"\bclass\s+\w+"

# --- fixed values: texts of examples ---
INSTRUCTIONS = {
    "function_explain": "Explain what this function does based on its documentation",
    "type_definition": "Explain this TypeScript type definition",
    "error_context": "Debug this TypeScript error",
    "test_assertion": "Analyze this test case and explain what it validates",
    "error_handling": "Explain how this code handles errors",
    "file_context": "Analyze this code and describe its purpose, structure, and key patterns",
    "doc_context": "Explain what this documentation describes and how it helps developers",
}
ID_PREFIXES = {
    "function_explain": "func", "type_definition": "type", "error_context": "tserr", "test_assertion": "test", "error_handling": "error",
    "file_context": "file", "doc_context": "doc",
}
FILE_CUT, FILE_MARK = 4000, "\n// ... (truncated)"
DOC_CUT, DOC_MARK = 3000, "\n\n... (truncated)"
DEFAULT_ERROR = "TypeScript error"
DEFAULT_TITLE = "test case"
TEST_TEXT = ('This test validates that "', '". It uses expectations to verify the behavior is correct.')
HEADING_TEXT = (
    'This documentation covers "',
    '". It provides information about usage, configuration, and API details relevant to developers working with this code.',
)
NO_SUMMARY = "This document provides reference information for developers."
NO_COUNTS = "contains module-level code and definitions."
ERROR_START = ('The code contains a TypeScript error suppressed with @ts-expect-error. The error message indicates: "', '".')
ERROR_ASSIGN = (
    " This is a type compatibility issue where a value's type does not match the expected type.", " The problematic code is: `", "`",
    " The fix would be to ensure the types are compatible, use a type assertion, or add proper type guards.",
)
ERROR_PROPERTY = (
    " This occurs when trying to access a property that does not exist on the type.", " The expression `", "` accesses a member that may not be present.",
    " Checking for the property's existence or using optional chaining (?.) would resolve this.",
)
ERROR_UNDEFINED = (
    " This happens when a value that could be `undefined` is used without a null check.", " The value in `", "` may be undefined at runtime.",
    " Adding a defensive check or default value would fix this.",
)
ERROR_GENERAL = " This is a general type safety issue that TypeScript detects at compile time. Reviewing the types involved and ensuring proper type annotations would resolve it."
TRY_START = "This code uses a try/catch block to handle errors gracefully."
TRY_TYPED = (" It catches `", "` exceptions as `", "`.")
TRY_ALL = (" It catches all exceptions as `", "`.")
TRY_BARE = " It catches all exceptions without filtering by type."
TRY_END = " The catch block can log errors, display user-friendly messages, or attempt recovery."
THROW_TYPED = (" It throws `", "` to signal error conditions.")
THROW_BARE = " It throws errors to signal exceptional conditions."
THROW_END = " Throwing errors allows calling code to handle failures appropriately."
NO_HANDLING = "This code implements error handling logic to manage exceptional conditions."
