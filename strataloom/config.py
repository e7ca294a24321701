"""Settings of profiling and generation, checked when they are made."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from strataloom.errors import InvalidRequestError

ENCODINGS = ("categorical", "numeric_discrete", "numeric_binned", "numeric_digit", "numeric_auto", "datetime", "character")
RARE_STRATEGIES = ("mask", "sample")
MODEL_SIZES = ("small", "medium", "large")


def _need(ok: bool, message: str, param: str) -> None:
    if not ok:
        raise InvalidRequestError(message, param)


def _whole(value: object) -> bool:
    return isinstance(value, int) and not isinstance(value, bool)


def check_scalars(n: object = None, seed: object = None, diversity: object = 1.0, rare_cutoff: object = 1.0, rare_strategy: object = None) -> None:
    """Check the scalar arguments of the public functions before any work starts."""
    _need(n is None or _whole(n) and n > 0, "n must be a positive whole number", "n")
    _need(seed is None or _whole(seed), "seed must be a whole number or None", "seed")
    _need(isinstance(diversity, (int, float)) and not isinstance(diversity, bool) and math.isfinite(diversity) and diversity > 0, "diversity must be above 0", "diversity")
    _need(isinstance(rare_cutoff, (int, float)) and not isinstance(rare_cutoff, bool) and 0 < rare_cutoff <= 1, "rare_cutoff must be above 0, 1 at most", "rare_cutoff")
    _need(rare_strategy is None or rare_strategy in RARE_STRATEGIES, f"rare_strategy must be one of {RARE_STRATEGIES}", "rare_strategy")


@dataclass(frozen=True)
class Synthetic:
    """How many rows to make, and how."""

    n: int | None = None
    seed: int | None = None
    diversity: float = 1.0
    rare_cutoff: float = 1.0
    rare_strategy: str | None = None

    def __post_init__(self) -> None:
        check_scalars(self.n, self.seed, self.diversity, self.rare_cutoff, self.rare_strategy)


def merged(preset: Synthetic | None, **given: object) -> Synthetic:
    """Arguments that are given win over the preset, the preset over the defaults; two different n are rejected."""
    out = preset or Synthetic()
    given = {k: v for k, v in given.items() if v is not None}
    if "n" in given and out.n is not None and given["n"] != out.n:
        raise InvalidRequestError(f"n is {given['n']} and, in the preset, {out.n}", "n")
    return replace(out, **given)


@dataclass(frozen=True)
class Bias:
    """Make target independent of the sensitive columns."""

    target: str
    sensitive: tuple[str, ...]

    def __post_init__(self) -> None:
        object.__setattr__(self, "sensitive", tuple([self.sensitive] if isinstance(self.sensitive, str) else self.sensitive))
        _need(isinstance(self.target, str) and bool(self.target), "target must name a column", "target")
        _need(bool(self.sensitive) and all(isinstance(s, str) and s for s in self.sensitive), "sensitive must name columns", "sensitive")
        _need(self.target not in self.sensitive, "target can't be sensitive", "sensitive")
        _need(len(set(self.sensitive)) == len(self.sensitive), "sensitive names a column twice", "sensitive")


@dataclass(frozen=True)
class Distribution:
    """Wanted probabilities of a column's categories; categories that aren't named share what is left."""

    column: str
    probabilities: dict[str, float]

    def __post_init__(self) -> None:
        _need(isinstance(self.column, str) and bool(self.column), "column must name a column", "column")
        _need(isinstance(self.probabilities, dict) and bool(self.probabilities), "probabilities must hold a category", "probabilities")
        for k, p in self.probabilities.items():
            _need(isinstance(k, str), "categories must be strings", "probabilities")
            _need(isinstance(p, (int, float)) and not isinstance(p, bool) and math.isfinite(p) and p >= 0, f"the probability of {k!r} must be finite, 0 at least", "probabilities")
        _need(sum(self.probabilities.values()) > 0, "all probabilities are 0", "probabilities")


@dataclass(frozen=True)
class Privacy:
    """Protection of rare values. threshold: rows that a value must have to be kept by name (None: 5, 6 or 7 by the seed)."""

    protect_rare: bool = True
    rare_strategy: str = "mask"
    enabled: bool = True
    noise: float = 0.0
    threshold: int | None = 5
    epsilon: float | None = None

    def __post_init__(self) -> None:
        _need(isinstance(self.protect_rare, bool) and isinstance(self.enabled, bool), "protect_rare and enabled must be booleans", "protect_rare")
        check_scalars(rare_strategy=self.rare_strategy)
        _need(isinstance(self.noise, (int, float)) and not isinstance(self.noise, bool) and math.isfinite(self.noise) and self.noise >= 0, "noise must be 0 at least", "noise")
        _need(self.threshold is None or _whole(self.threshold) and self.threshold >= 1, "threshold must be 1 at least", "threshold")
        _need(self.epsilon is None or self.epsilon > 0, "epsilon must be above 0", "epsilon")


@dataclass(frozen=True)
class ModelConfig:
    """Settings of a model: column encodings by name, privacy, seed, width of embeddings and of their tables, and the share of rows held out."""

    privacy: Privacy = field(default_factory=Privacy)
    encoding_types: dict[str, str] = field(default_factory=dict)
    parent_encoding_types: dict[str, str] = field(default_factory=dict)
    seed: int | None = None
    n: int | None = None
    embedding_dim: int = 64
    model_size: str = "medium"
    val_split: float = 0.1

    def __post_init__(self) -> None:
        check_scalars(self.n, self.seed)
        for name, given in (("encoding_types", self.encoding_types), ("parent_encoding_types", self.parent_encoding_types)):
            bad = {k: v for k, v in given.items() if v not in ENCODINGS}
            _need(not bad, f"unknown encodings: {bad}", name)
        _need(_whole(self.embedding_dim) and self.embedding_dim > 0, "embedding_dim must be above 0", "embedding_dim")
        _need(self.model_size in MODEL_SIZES, f"model_size must be one of {MODEL_SIZES}", "model_size")
        _need(isinstance(self.val_split, (int, float)) and not isinstance(self.val_split, bool) and 0 < self.val_split < 1, "val_split must be above 0 and below 1", "val_split")

    def to_dict(self) -> dict:
        from dataclasses import asdict

        return asdict(self)


def resolve_config(config: ModelConfig | dict | None) -> ModelConfig:
    """A config from a dict, or the default; never changes what the caller holds."""
    if config is None or isinstance(config, ModelConfig):
        return config or ModelConfig()
    _need(isinstance(config, dict), "config must be a ModelConfig or a dict", "config")
    unknown = set(config) - {f for f in ModelConfig.__dataclass_fields__}
    _need(not unknown, f"unknown settings: {sorted(unknown)}", "config")
    own = dict(config)
    if isinstance(own.get("privacy"), dict):
        own["privacy"] = Privacy(**own["privacy"])
    return ModelConfig(**own)
