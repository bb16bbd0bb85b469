"""Settings of a run: a TOML file, platforms of model services, and their checks."""

from __future__ import annotations

import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

from .operators.chunker import Counter, count_characters, tokenizer_counter
from .operators.conversation import DIALECTS, parse_aliases


@dataclass(frozen=True)
class Settings:
    """One run. Values for training and serving are carried for other tools and not used here."""

    novel_txt: str
    target_role: str
    run_name: str
    novel_title: str = ""
    base_dir: str = "."
    model_choice: str = ""
    model_ids: Mapping[str, str] = field(default_factory=dict)
    extraction_backend: str = "local_model"
    llm_platform: str = "custom"
    local_model_id_override: str = ""
    max_workers: int = 8
    chunk_size_tokens: int = 500
    chunk_overlap_tokens: int = 50
    valid_ratio: float = 0.05
    max_conversations: int = 0
    seed: int = 42
    temperature: float = 0.6
    tokenizer: str = ""  # a file of the tokenizers library; chunk budgets count characters without it
    dialect: str = "pipeline"  # or "script"
    save_chunk_text: bool = False
    other: Mapping[str, Any] = field(default_factory=dict)

    @property
    def aliases(self) -> list[str]:
        return parse_aliases(self.target_role)

    @property
    def canonical_role(self) -> str:
        return self.aliases[0]

    @property
    def model_id(self) -> str:
        return self.model_ids[self.model_choice]

    @property
    def extraction_model_id(self) -> str:
        return self.local_model_id_override.strip() or self.model_id

    def path(self, *parts: str) -> str:
        return str(Path(self.base_dir, *parts))

    @property
    def counter(self) -> Counter:
        """What chunk budgets count: tokens of the tokenizer's file, else characters."""
        return tokenizer_counter(self.tokenizer) if self.tokenizer else count_characters

    @property
    def raw_lines(self) -> str:
        return self.path("data", "raw", f"{self.run_name}_dialogues.jsonl")

    @property
    def train_file(self) -> str:
        return self.path("data", f"{self.run_name}_chat_train.json")

    @property
    def valid_file(self) -> str:
        return self.path("data", f"{self.run_name}_chat_valid.json")


def load_settings(path: str, make_folders: bool = False) -> Settings:
    """Read a TOML file. Relative inputs are taken from its folder; unknown keys go to ``other``."""
    with open(path, "rb") as f:
        found = tomllib.load(f)
    names = {f.name for f in fields(Settings)} - {"other"}
    known = {k: v for k, v in found.items() if k in names}
    known.setdefault("base_dir", str(Path(path).resolve().parent))
    novel = Path(known["novel_txt"])
    known["novel_txt"] = str(novel if novel.is_absolute() else Path(known["base_dir"]) / novel)
    if known.get("tokenizer"):
        file = Path(known["tokenizer"])
        known["tokenizer"] = str(file if file.is_absolute() else Path(known["base_dir"]) / file)
    settings = Settings(**known, other={k: v for k, v in found.items() if k not in names})
    if settings.dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {', '.join(DIALECTS)}")
    if not settings.aliases:
        raise ValueError("target_role is empty")
    if not Path(settings.novel_txt).exists():
        raise FileNotFoundError(settings.novel_txt)
    if make_folders:
        for name in ("data/raw", "cache", "logs", "status"):
            Path(settings.base_dir, name).mkdir(parents=True, exist_ok=True)
    return settings


@dataclass(frozen=True)
class Platform:
    """Where a service's key and address are found."""

    api_key_env: str
    base_url_env: str
    default_base_url: str
    default_model: str


# Services with an OpenAI-compatible interface.
PLATFORMS = {
    "deepseek": Platform("DEEPSEEK_API", "DEEPSEEK_BASE_URL", "https://api.deepseek.com", "deepseek-chat"),
    "openai": Platform("OPENAI_API_KEY", "OPENAI_BASE_URL", "https://api.openai.com/v1", "gpt-3.5-turbo"),
    "siliconflow": Platform("SILICONFLOW_API_KEY", "SILICONFLOW_BASE_URL", "https://api.siliconflow.cn/v1", "Qwen/Qwen3-30B-A3B-Instruct-2507"),
    "moonshot": Platform("MOONSHOT_API_KEY", "MOONSHOT_BASE_URL", "https://api.moonshot.cn/v1", "kimi-k2-0905-preview"),
    "custom": Platform("CUSTOM_API_KEY", "CUSTOM_BASE_URL", "https://your-custom-endpoint.com/v1", "custom-model"),
}


def resolve_platform(name: str, env: Mapping[str, str]) -> dict[str, str]:
    """Key, address and model of a platform from environment settings."""
    if name not in PLATFORMS:
        raise ValueError(f"unknown platform {name!r}; known are {', '.join(PLATFORMS)}")
    p = PLATFORMS[name]
    if not env.get(p.api_key_env):
        raise ValueError(f"{p.api_key_env} is not set")
    return {"api_key": env[p.api_key_env], "base_url": env.get(p.base_url_env) or p.default_base_url, "model": p.default_model}


def setting_errors(max_tokens: int, overlap_tokens: int, temperature: float, platform: str | None = None, env: Mapping[str, str] | None = None) -> list[str]:
    """What is wrong with the settings of an extraction; nothing if all is well."""
    errors = []
    if platform is not None:
        try:
            resolve_platform(platform, env or {})
        except ValueError as error:
            errors.append(str(error))
    if max_tokens <= overlap_tokens:
        errors.append("the chunk budget must be larger than the overlap")
    if not 0 <= temperature <= 2:
        errors.append("the temperature must lie between 0 and 2")
    return errors


# The keys of a training file that settings carry under the same name, and those
# that are the same in every run.
TRAINING_KEYS = ("lora_rank", "lora_alpha", "lora_dropout", "num_train_epochs", "per_device_train_batch_size", "gradient_accumulation_steps", "learning_rate", "warmup_ratio", "lr_scheduler_type", "cutoff_len", "logging_steps", "save_steps", "eval_steps", "gradient_checkpointing")
TRAINING_CONSTANTS = {"finetuning_type": "lora", "lora_target": "all", "evaluation_strategy": "steps", "save_strategy": "steps", "load_best_model_at_end": True, "bf16": True, "optim": "adamw_torch", "report_to": "none"}


def training_values(settings: Settings, model: str, template: str, dataset: str) -> dict[str, Any]:
    """What a trainer's YAML file says about a run: its model, data, and the settings it carries."""
    where = {"model_name_or_path": model, "template": template, "dataset": dataset, "dataset_dir": settings.path("data"), "output_dir": settings.path("outputs", settings.run_name)}
    carried = {k: settings.other[k] for k in TRAINING_KEYS if k in settings.other}
    return where | carried | TRAINING_CONSTANTS
