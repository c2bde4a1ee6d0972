"""The job plan: a YAML mapping, validated, with defaults; and the environment file."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from pathlib import Path

from ..functions import fixed


class PlanError(ValueError):
    """What is wrong with a plan, as ``path: message`` lines."""


@dataclass(frozen=True)
class Search:
    query: str
    limit: int = 100


@dataclass(frozen=True)
class Discovery:
    search: Search | None = None
    users: list[str] | None = None
    explicit_repos: list[str] | None = None
    per_user_limit: int = 100


@dataclass(frozen=True)
class Licenses:
    allow: list[str] = field(default_factory=lambda: list(fixed.DEFAULT_LICENSES))
    require_detected: bool = True


@dataclass(frozen=True)
class Exclude:
    paths: list[str] = field(default_factory=lambda: list(fixed.DEFAULT_EXCLUDED_PATHS))
    extensions: list[str] = field(default_factory=lambda: list(fixed.DEFAULT_EXCLUDED_EXTENSIONS))
    max_file_size_kb: int = 500


@dataclass(frozen=True)
class SecretScan:
    enabled: bool = True
    action: str = "drop"


@dataclass(frozen=True)
class Plan:
    name: str = "my-dataset"
    max_size_gb: float = 50
    discovery: Discovery | None = None
    licenses: Licenses = field(default_factory=Licenses)
    min_stars: int = 0
    languages: list[str] | None = None
    exclude: Exclude = field(default_factory=Exclude)
    dedupe: bool = True
    secret_scan: SecretScan = field(default_factory=SecretScan)
    output_format: str = "raw+jsonl"
    token_env: str = "GITHUB_TOKEN"
    concurrency: int = 5


class _Reader:
    def __init__(self, data: dict, issues: list[str], at: str = ""):
        self.data, self.issues, self.at = data, issues, at

    def issue(self, key: str, what: str) -> None:
        self.issues.append(f"{self.at}{key}: {what}")

    def part(self, key: str) -> _Reader | None:
        value = self.data.get(key)
        if value is not None and not isinstance(value, dict):
            self.issue(key, "must be a mapping")
            return None
        return None if value is None else _Reader(value, self.issues, f"{self.at}{key}.")

    def text(self, key: str, default: str | None = None, among: tuple[str, ...] = ()) -> str | None:
        value = self.data.get(key, default)
        if value is None and default is None and key not in self.data:
            self.issue(key, "is required")
        elif not isinstance(value, str) or not value:
            self.issue(key, "must be a non-empty string")
        elif among and value not in among:
            self.issue(key, f"must be one of {', '.join(among)}")
        return value

    def whole(self, key: str, default: int, low: int, high: int | None = None) -> int:
        value = self.data.get(key, default)
        if isinstance(value, bool) or not isinstance(value, int) or value < low or high is not None and value > high:
            self.issue(key, f"must be a whole number from {low}" + (f" to {high}" if high is not None else ""))
        return value

    def flag(self, key: str, default: bool) -> bool:
        value = self.data.get(key, default)
        if not isinstance(value, bool):
            self.issue(key, "must be true or false")
        return value

    def texts(self, key: str, default: list[str] | None, empty: bool = False) -> list[str] | None:
        value = self.data.get(key, default)
        if value is not None and (not isinstance(value, list) or not all(isinstance(x, str) and (x or empty) for x in value)):
            self.issue(key, "must be a list of strings")
        return value


def plan_from_dict(data: object) -> Plan:
    """A validated plan; unknown keys are ignored."""
    if not isinstance(data, dict):
        raise PlanError("the plan must be a mapping")
    issues: list[str] = []
    r, empty = _Reader(data, issues), _Reader({}, issues)
    size = data.get("maxSizeGB", 50)
    if isinstance(size, bool) or not isinstance(size, int | float) or size <= 0:
        issues.append("maxSizeGB: must be a number above 0")
    found = None
    if (d := r.part("discovery")) is not None:
        s = d.part("search")
        found = Discovery(
            Search(s.text("query"), s.whole("limit", 100, 1, 2000)) if s else None, d.texts("users", None), d.texts("explicitRepos", None), d.whole("perUserLimit", 100, 1, 2000)
        )
    lic, exc, sec = r.part("licenses") or empty, r.part("exclude") or empty, r.part("secretScan") or empty
    plan = Plan(
        name=r.text("name", "my-dataset"), max_size_gb=size, discovery=found,
        licenses=Licenses(lic.texts("allow", list(fixed.DEFAULT_LICENSES)), lic.flag("requireDetected", True)),
        min_stars=(r.part("stars") or empty).whole("min", 0, 0),
        languages=lang.texts("allow", None) if (lang := r.part("languages")) else None,
        exclude=Exclude(exc.texts("paths", list(fixed.DEFAULT_EXCLUDED_PATHS), True), exc.texts("extensions", list(fixed.DEFAULT_EXCLUDED_EXTENSIONS), True), exc.whole("maxFileSizeKB", 500, 1)),
        dedupe=(r.part("dedupe") or empty).flag("enabled", True),
        secret_scan=SecretScan(sec.flag("enabled", True), sec.text("action", "drop", ("drop", "redact"))),
        output_format=(r.part("output") or empty).text("format", "raw+jsonl", ("raw+jsonl",)),
        token_env=(r.part("auth") or empty).text("tokenEnv", "GITHUB_TOKEN"), concurrency=r.whole("concurrency", 5, 1),
    )
    if issues:
        raise PlanError("\n".join(issues))
    return plan


def parse_plan(path: str) -> Plan:
    """Read a plan file; errors tell apart a missing file, bad YAML, a root that is no mapping, and bad values."""
    try:
        import yaml
    except ImportError as e:
        raise PlanError("reading plan files needs a YAML library; use plan_from_dict") from e
    try:
        text = Path(path).read_text(encoding="utf-8")
    except OSError as e:
        raise PlanError(f"cannot read {path}: {e.strerror}") from e
    try:
        data = yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise PlanError(f"{path} is not YAML: {e}") from e
    return plan_from_dict(data)


def dump_plan(plan: Plan) -> str:
    """The plan as YAML; sections without content are left out."""
    q = lambda x: '"' + str(x).replace("\\", "\\\\").replace('"', '\\"') + '"'
    yes = lambda x: "true" if x else "false"
    out = [f"name: {q(plan.name)}", f"maxSizeGB: {plan.max_size_gb:g}"]
    each = lambda key, values, pad: [f"{pad}{key}:" + (" []" if not values else ""), *(f"{pad}  - {q(v)}" for v in values)]
    if d := plan.discovery:
        out.append("discovery:")
        if d.search:
            out += ["  search:", f"    query: {q(d.search.query)}", f"    limit: {d.search.limit}"]
        if d.users:
            out += each("users", d.users, "  ")
        if d.explicit_repos:
            out += each("explicitRepos", d.explicit_repos, "  ")
        out.append(f"  perUserLimit: {d.per_user_limit}")
    out += ["licenses:", *each("allow", plan.licenses.allow, "  "), f"  requireDetected: {yes(plan.licenses.require_detected)}", "stars:", f"  min: {plan.min_stars}"]
    if plan.languages is not None:
        out += ["languages:", *each("allow", plan.languages, "  ")]
    e = plan.exclude
    out += ["exclude:", *each("paths", e.paths, "  "), *each("extensions", e.extensions, "  "), f"  maxFileSizeKB: {e.max_file_size_kb}", "dedupe:", f"  enabled: {yes(plan.dedupe)}"]
    out += ["secretScan:", f"  enabled: {yes(plan.secret_scan.enabled)}", f"  action: {plan.secret_scan.action}", "output:", f"  format: {plan.output_format}"]
    return "\n".join([*out, "auth:", f"  tokenEnv: {plan.token_env}", f"concurrency: {plan.concurrency}", ""])


def wizard_issues(answers: dict) -> list[str]:
    """Checks on interactive answers, stricter than a plan's: name, maxSizeGB, limits, explicitRepos, concurrency."""
    out = []
    if not re.fullmatch(r"[A-Za-z0-9_-]+", answers.get("name", "my-dataset")):
        out.append("name: only letters, digits, dash and underscore")
    if not 0 < float(answers.get("maxSizeGB", 50)) <= 1000:
        out.append("maxSizeGB: above 0, at most 1000")
    for key in ("searchLimit", "perUserLimit"):
        if not 1 <= int(answers.get(key, 100)) <= 2000:
            out.append(f"{key}: 1 to 2000")
    out += [f"explicitRepos: {x} is not owner/repo" for x in answers.get("explicitRepos", []) if not re.fullmatch(r"[^/\s]+/[^/\s]+", x)]
    if not 1 <= int(answers.get("concurrency", 5)) <= 20:
        out.append("concurrency: 1 to 20")
    return out


def load_env(path: str = ".env") -> dict[str, str]:
    """Set K=V lines that the environment does not have; blank lines, comments and unreadable files are passed over."""
    set_: dict[str, str] = {}
    try:
        lines = Path(path).read_text(encoding="utf-8").splitlines()
    except OSError:
        return set_
    for line in lines:
        key, sep, value = line.strip().partition("=")
        if not sep or key.startswith("#") or not key.strip():
            continue
        value = value.strip()
        value = value[1:] if value[:1] in ("'", '"') else value
        value = value[:-1] if value[-1:] in ("'", '"') else value
        if key.strip() not in os.environ:
            os.environ[key.strip()] = set_[key.strip()] = value
    return set_
