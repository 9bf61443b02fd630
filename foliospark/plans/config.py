"""Settings of a run, from YAML or a dict, with defaults."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class Input:
    books_dir: str
    glob: str = "*.pdf"


@dataclass(frozen=True)
class Runtime:
    model: str
    temperature: float = 0.2
    max_pages_per_book: int = 10
    dpi: int = 150
    retry_dpi: int = 220
    max_unusable_retries: int = 1
    request_timeout_seconds: int = 120
    sleep_seconds_between_requests: float = 0.4
    append_mode: bool = True
    generation_input_cost_per_1m_tokens_usd: float = 5.0
    generation_output_cost_per_1m_tokens_usd: float = 15.0
    judge_input_cost_per_1m_tokens_usd: float = 5.0
    judge_output_cost_per_1m_tokens_usd: float = 15.0
    log_prompts: bool = True
    prompt_log_path: str = "./output/prompt_log.jsonl"
    log_api_metrics: bool = True
    api_metrics_log_path: str = "./output/api_metrics.jsonl"
    process_log_path: str = "./output/process_log.jsonl"
    verbose_success_logs: bool = True
    failed_writes_log_path: str = "./output/failed_writes.jsonl"
    checkpoint_enabled: bool = True
    checkpoint_path: str = "./output/run_checkpoint.json"
    parallel_critique_workers: int = 1
    parallel_future_timeout_seconds: int = 300


@dataclass(frozen=True)
class Dataset:
    output_path: str
    skipped_pages_output_path: str = "./output/skipped_pages.jsonl"
    qas_per_page: int = 6
    user_profile: str = ""
    variety: dict[str, Any] = field(default_factory=dict)
    citation: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Quality:
    enabled: bool = True
    use_model_self_critique: bool = True
    min_grounding_score: float = 0.55
    min_usefulness_score: float = 0.5
    duplicate_similarity_threshold: float = 0.9
    require_citation_match_if_text_available: bool = True
    critique_model: str = ""
    quality_log_path: str = "./output/quality_log.jsonl"


@dataclass(frozen=True)
class Analytics:
    report_path: str = "./output/analytics_report.json"
    token_stats_path: str = "./output/token_stats.json"


@dataclass(frozen=True)
class Prompts:
    system: str = "Return strict JSON that is grounded in the page."


@dataclass(frozen=True)
class CrossPage:
    enabled: bool = True
    min_pages_per_pack: int = 2
    max_pages_per_pack: int = 3
    pack_overlap_window: int = 1
    use_local_qas_as_hints: bool = True
    require_quote_match_if_text_available: bool = True
    merge_into_final_dataset: bool = True
    min_cross_page_grounding_score: float = 0.6
    min_cross_page_usefulness_score: float = 0.55
    min_multi_page_score: float = 0.6
    synthesis_model: str = ""
    synthesis_temperature: float = 0.1
    max_cross_page_qas_per_pack: int = 3
    max_evidence_quotes_per_item: int = 3
    output_path: str = "./output/cross_page_chatml_dataset.jsonl"
    artifact_path: str = "./output/page_artifacts.jsonl"
    quality_log_path: str = "./output/cross_page_quality_log.jsonl"


@dataclass(frozen=True)
class Settings:
    input: Input
    runtime: Runtime
    dataset: Dataset
    quality: Quality
    cross_page: CrossPage
    analytics: Analytics = Analytics()
    prompts: Prompts = Prompts()


_KINDS = {"float": float, "int": int, "bool": bool, "str": str}


def _block(kind: type, raw: dict[str, Any] | None) -> Any:
    raw = raw or {}
    return kind(**{f.name: _KINDS.get(str(f.type), lambda x: x)(raw[f.name]) for f in fields(kind) if f.name in raw})


_BLOCKS = {"input": Input, "runtime": Runtime, "dataset": Dataset, "quality": Quality, "cross_page": CrossPage, "analytics": Analytics, "prompts": Prompts}


def settings(raw: dict[str, Any]) -> Settings:
    """Settings from nested dicts: unknown keys are ignored, values cast, and input.books_dir, runtime.model and
    dataset.output_path must be given (else TypeError). Models for critique and synthesis default to runtime.model."""
    s = Settings(**{name: _block(kind, raw.get(name)) for name, kind in _BLOCKS.items()})
    return replace(s, quality=replace(s.quality, critique_model=s.quality.critique_model or s.runtime.model), cross_page=replace(s.cross_page, synthesis_model=s.cross_page.synthesis_model or s.runtime.model))


def load_settings(path: str | Path) -> Settings:
    import yaml

    return settings(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
