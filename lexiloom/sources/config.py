"""Benchmark configuration from YAML, checked as it is read."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

STAGES = ("translate", "judge", "correct")
MODES = ("batch", "parallel")


class ConfigError(ValueError):
    """A configuration that cannot be used."""


def _need(raw: dict, key: str, where: str) -> Any:
    if raw.get(key) is None:
        raise ConfigError(f"{where} needs {key!r}")
    return raw[key]


def _known(cls, raw: dict, where: str):
    """The dataclass from a mapping of its fields; other keys are an error."""
    names = {f.name for f in fields(cls)}
    if extra := sorted(set(raw) - names):
        raise ConfigError(f"unknown {where} keys {extra}")
    return cls(**raw)


# The keys of users' files and their defaults, in the classes below.
@dataclass(frozen=True)
class Unit:
    config: str
    split: str
    path: str | None = None

    @property
    def label(self) -> str:
        return f"{self.config}/{self.split}"


@dataclass
class Inference:
    mode: str = "batch"
    num_workers: int = 16
    temperature: float = 0.2
    max_output_tokens: int | None = 8192
    json_mode: bool = True
    thinking_budget: int | None = None
    max_requests_per_batch: int = 50_000
    poll_interval_seconds: int = 60
    poll_timeout_hours: float = 48.0
    delete_uploaded_files: bool = False
    litellm_model: str | None = None
    api_base: str | None = None
    api_key_env: str | None = None
    num_retries: int = 3
    request_timeout: int = 600
    extra_params: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.mode not in MODES:
            raise ConfigError(f"inference mode {self.mode!r} is none of {MODES}")

    def provider_model(self, model: str) -> str:
        if self.mode == "batch":
            return model
        return self.litellm_model or (model if "/" in model else f"vertex_ai/{model}")


@dataclass
class Fallback:
    enabled: bool = False
    max_attempts: int = 1
    model: str | None = None
    inference: Inference = field(default_factory=lambda: Inference(mode="parallel"))


@dataclass
class Stage:
    name: str
    enabled: bool = True
    prompt: str = ""
    model: str = ""
    inference: Inference = field(default_factory=Inference)
    output_format: str = "json"
    max_attempts: int = 3
    fallback: Fallback = field(default_factory=Fallback)
    pass_threshold: float = 7.0
    score_scale: float = 10.0
    max_score: float | None = None


@dataclass
class Output:
    root: str = "./data"
    destination: str = "local"
    hub_repo: str | None = None
    private: bool = True
    column_template: str = "{field}_{language}"
    keep_source_columns: bool = True
    include_quality_columns: bool = False
    format: str = "jsonl"


@dataclass
class Review:
    fail_threshold: float | None = None
    sample_rate: float = 0.25
    sample_seed: str = "human-review-v1"
    csv: bool = True
    include_judge_details: bool = True
    include_all_rows: bool = True
    human_fields: list[str] = field(default_factory=lambda: ["human_verdict", "human_score", "human_issue", "human_comments", "reviewer"])
    prefer_best_translation: bool = False
    queue_regressions: bool = False
    csv_all_rows: bool = False


@dataclass
class Config:
    benchmark: str
    units: list[Unit]
    id_field: str
    languages: list[str]
    codes: dict[str, str]
    scripts: dict[str, str]
    fields: list | dict
    stages: dict[str, Stage]
    output: Output
    review: Review
    pricing: dict[str, dict]

    def stage(self, name: str) -> Stage:
        if name not in self.stages:
            raise ConfigError(f"stage {name!r} is not configured")
        return self.stages[name]

    def select_units(self, configs: list[str] | None = None, splits: list[str] | None = None) -> list[Unit]:
        out = [u for u in self.units if (not configs or u.config in configs) and (not splits or u.split in splits)]
        if not out:
            raise ConfigError(f"no unit matches configs {configs} and splits {splits}")
        return out


def _units(source: dict, base: Path) -> list[Unit]:
    kind = source.get("type", "huggingface")
    place = lambda p: str((base / os.path.expanduser(str(p))).resolve())
    if kind == "local":
        out = []
        for key, value in _need(source, "files", "a local source").items():
            pairs = [(str(key), s, p) for s, p in value.items()] if isinstance(value, dict) else [("default", key, value)]
            out += [Unit(c, str(s), place(p)) for c, s, p in pairs]
        return out
    if kind != "huggingface":
        raise ConfigError(f"source type {kind!r} is neither 'huggingface' nor 'local'")
    if source.get("configs"):
        return [Unit(str(c), str(s)) for c, splits in source["configs"].items() for s in splits]
    return [Unit("default", str(s)) for s in _need(source, "splits", "a source without configs")]


def _stage(name: str, raw: dict, defaults: dict, base: Path) -> Stage:
    merged = {**defaults, **raw}  # a stage's key replaces the whole default
    inference = _known(Inference, dict(merged.get("inference") or {}), "inference")
    back = dict(merged.get("fallback") or {})
    own = {k: back.pop(k) for k in ("enabled", "max_attempts", "model") if k in back}
    shared = {k: getattr(inference, k) for k in ("temperature", "max_output_tokens", "json_mode", "thinking_budget")}
    fallback = Fallback(**own, inference=_known(Inference, {"mode": "parallel", **shared, **back}, "fallback"))
    number = lambda k, d: d if merged.get(k) is None else float(merged[k])
    prompt = merged.get("prompt")
    return Stage(
        name, bool(merged.get("enabled", True)), str((base / os.path.expanduser(prompt)).resolve()) if prompt else "", str(merged.get("model", "")), inference, merged.get("output_format", "json"),
        int(merged.get("max_attempts", 3)), fallback, number("pass_threshold", 7.0), number("score_scale", 10.0), number("max_score", None),
    )


def parse(raw: dict, base: Path) -> Config:
    """A checked configuration from a mapping; paths are relative to `base`."""
    if "vertex" in raw:
        raise ConfigError("provider settings belong in the environment, not in a 'vertex' block")
    source, languages = _need(raw, "source", "the configuration"), _need(raw, "languages", "the configuration")
    codes = {str(k): str(v) for k, v in (languages if isinstance(languages, dict) else raw.get("language_codes") or {}).items()}
    given = raw.get("stages") or {}
    pick = lambda cls, key: _known(cls, dict(raw.get(key) or {}), key)
    c = Config(
        benchmark=str(_need(raw, "benchmark", "the configuration")),
        units=_units(source, base),
        id_field=source.get("id_field") or "id",
        languages=[str(x) for x in languages],
        codes=codes,
        scripts={str(k): str(v) for k, v in (raw.get("language_scripts") or {}).items()},
        fields=_need(raw, "fields", "the configuration"),
        stages={n: _stage(n, dict(given.get(n) or {}), raw.get("stage_defaults") or {}, base) for n in STAGES if n in given or n == "translate"},
        output=pick(Output, "output"),
        review=pick(Review, "review"),
        pricing=raw.get("pricing") or {},
    )
    check(c)
    return c


def check(c: Config) -> None:
    if not c.languages:
        raise ConfigError("no languages")
    if not c.units:
        raise ConfigError("no units")
    for s in c.stages.values():
        if s.enabled and not (s.model and s.prompt):
            raise ConfigError(f"stage {s.name} needs a model and a prompt")
        if s.enabled and not Path(s.prompt).exists():
            raise ConfigError(f"no prompt {s.prompt}")
        if s.output_format not in ("json", "sections"):
            raise ConfigError(f"output format {s.output_format!r} is neither 'json' nor 'sections'")
    if not 0 <= c.review.sample_rate <= 1:
        raise ConfigError("sample_rate is not between 0 and 1")
    if c.output.destination not in ("local", "huggingface") or (c.output.destination == "huggingface" and not c.output.hub_repo):
        raise ConfigError("the destination is 'local', or 'huggingface' with a hub_repo")


def load(path: str) -> Config:
    import yaml

    with open(path, encoding="utf-8") as f:
        return parse(yaml.safe_load(f) or {}, Path(path).expanduser().resolve().parent)
