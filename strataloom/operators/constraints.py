"""Compiling wishes about generated rows into probabilities by code, and the order in which columns are drawn."""

from __future__ import annotations

import logging

from strataloom.config import Bias, Distribution
from strataloom.errors import InvalidRequestError
from strataloom.functions import values as V
from strataloom.operators.profile import Profile, code_name

LOG = logging.getLogger("strataloom")
#: Probabilities by code column and code. A code that isn't named keeps what the model says, within what is left.
Weights = dict[str, dict[int, float]]


def rare_weights(profile: Profile, rare: str) -> Weights:
    """No rare token where values are sampled or none is rare, none ever for discrete numbers, no unknown bin."""
    out: Weights = {}
    for p in profile.columns.values():
        if p.encoding == "categorical" and p.n_labels > 1 and (rare == "sample" or not p.rare) or p.encoding == "numeric_discrete" and p.n_labels > 1:
            out[code_name(p.name, "cat")] = {0: 0.0}
        elif p.encoding == "numeric_binned" and p.subs["bin"] > 1:
            out[code_name(p.name, "bin")] = {p.specials.index(V.UNKNOWN): 0.0}
    return out


def distribution_weights(profile: Profile, wanted: list[Distribution]) -> Weights:
    """Probabilities of named categories, scaled down if they exceed 1 together."""
    out: Weights = {}
    for d in wanted:
        p = profile.columns.get(d.column)
        if p is None:
            raise InvalidRequestError(f"no column {d.column!r}", "distribution")
        if "cat" not in p.subs:
            raise InvalidRequestError(f"{d.column!r} isn't encoded by categories", "distribution")
        codes = p.codes_of(list(d.probabilities))
        known = {k: x for k, x in d.probabilities.items() if k in codes}
        if len(known) < len(d.probabilities):
            LOG.warning("categories of %s that aren't known: %s", d.column, sorted(set(d.probabilities) - set(known)))
        if not sum(known.values()):
            raise InvalidRequestError(f"no known category of {d.column!r} has a probability above 0", "distribution")
        scale = max(1.0, sum(known.values()))
        out[code_name(d.column, "cat")] = {codes[k]: x / scale for k, x in known.items()}
    return out


def imputation_weights(profile: Profile, columns: list[str]) -> Weights:
    """No null (and no rare token) in the columns to fill."""
    out: Weights = {}
    for name in columns:
        p = profile.columns[name]
        if "nan" in p.subs:
            out[code_name(name, "nan")] = {1: 0.0}
        if "cat" in p.subs:
            out[code_name(name, "cat")] = {i: 0.0 for i, v in enumerate(p.labels) if v == V.NULL or v == V.RARE and p.n_labels > 1 + p.has_null}
        if "bin" in p.subs and V.NULL in p.specials:
            out[code_name(name, "bin")] = {p.specials.index(V.NULL): 0.0, p.specials.index(V.UNKNOWN): 0.0}
    return out


def merged_weights(*many: Weights) -> Weights:
    """All weights; of two for one code the later."""
    out: Weights = {}
    for w in many:
        for column, codes in w.items():
            out[column] = out.get(column, {}) | codes
    return out


def check_bias(profile: Profile, bias: Bias) -> None:
    """Target and sensitive columns exist and are encoded by categories."""
    for name in (bias.target, *bias.sensitive):
        if name not in profile.columns:
            raise InvalidRequestError(f"no column {name!r}", "bias")
        if "cat" not in profile.columns[name].subs:
            raise InvalidRequestError(f"{name!r} isn't encoded by categories", "bias")


def column_order(features: list[str], conditions: list[str] = (), wanted: list[str] = (), imputed: list[str] = (), bias: Bias | None = None) -> list[str]:
    """Features in the order of drawing: conditions, wanted distributions, sensitive ones, the rest, those to fill, the target."""
    sensitive = list(bias.sensitive) if bias else []
    out: list[str] = [c for c in conditions if c not in imputed]
    out += [c for c in wanted if c not in imputed]
    out += [c for c in sensitive if c not in imputed] + [c for c in sensitive if c in imputed]
    out += [c for c in features if c not in imputed] + list(imputed)
    target = bias.target if bias else None
    return [c for c in dict.fromkeys(out) if c in features and c != target] + [target] * bool(target)
