"""Recipes: what a stage reads, how much, in what proportions; validated before anything runs."""

from __future__ import annotations

import math
from typing import Any

DATA_DEFAULTS: dict[str, Any] = {
    "max_seq_length": 4096, "candidate_oversample": 1.35, "shuffle_buffer": 10_000, "validation_fraction": 0.02, "min_validation_examples": 0,
    "max_category_deviation": 1.0, "max_reasoning_deviation": 1.0, "min_token_budget_fraction": 0.0, "max_examples_per_group": 0,
    "max_tool_output_chars": 12_000, "max_tool_messages": 48, "max_repeated_message_run": 2, "min_tokens": 32, "max_assistant_chars": 20_000,
}
MAX_LEARNING_RATE = 0.01


def load_config(path: str) -> dict[str, Any]:
    """A validated recipe from a YAML file (or JSON, where the YAML reader isn't installed)."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml
    except ImportError:
        import json

        config = json.loads(text)
    else:
        config = yaml.safe_load(text)
    validate(config)
    return config


def check_shares(name: str, shares: dict[str, float]) -> None:
    if not shares or any(not isinstance(w, (int, float)) or isinstance(w, bool) or w < 0 for w in shares.values()):
        raise ValueError(f"{name}: shares are numbers from 0 on")
    if not math.isclose(sum(shares.values()), 1.0, abs_tol=1e-6):
        raise ValueError(f"{name}: shares add up to {sum(shares.values()):g}, not to 1")


def check_range(name: str, value: float, low: float, high: float, open_low: bool = False) -> None:
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not (low < value if open_low else low <= value) or value > high:
        raise ValueError(f"{name} is {value!r}, expected {'more than ' if open_low else ''}{low} to {high}")


def validate(config: dict[str, Any]) -> None:
    """Raises ValueError with the first thing that is wrong."""
    for part in ("data", "stages", "sources"):
        if not config.get(part):
            raise ValueError(f"{part} is missing")
    for name, stage in config["stages"].items():
        data, train = data_of(config, name), training_of(config, name)
        check_range(f"{name}.token_budget", stage.get("token_budget", 0), 0, math.inf, open_low=True)
        check_shares(f"{name}.category_weights", stage.get("category_weights", {}))
        check_shares(f"{name}.reasoning_distribution", data.get("reasoning_distribution", {}))
        check_range(f"{name}.max_seq_length", data["max_seq_length"], 1, math.inf)
        check_range(f"{name}.candidate_oversample", data["candidate_oversample"], 1, math.inf)
        check_range(f"{name}.validation_fraction", data["validation_fraction"], 0, 0.999999)
        for key in ("max_category_deviation", "max_reasoning_deviation", "min_token_budget_fraction"):
            check_range(f"{name}.{key}", data[key], 0, 1)
        for key in ("min_validation_examples", "max_examples_per_group", "max_tool_messages"):
            check_range(f"{name}.{key}", data[key], 0, math.inf)
        if "learning_rate" in train:
            check_range(f"{name}.learning_rate", train["learning_rate"], 0, MAX_LEARNING_RATE, open_low=True)
        if train.get("min_steps", 0) > train.get("max_steps", math.inf):
            raise ValueError(f"{name}: more steps at least than at most")
        if (other := stage.get("data_stage")) and other not in config["stages"]:
            raise ValueError(f"{name}: unknown data stage {other}")
    by_category: dict[str, dict[str, float]] = {}
    for source in config["sources"]:
        by_category.setdefault(source["category"], {})[source["name"]] = source.get("source_weight", 0)
    for category, shares in by_category.items():
        check_shares(f"sources of {category}", shares)
    used = {c for s in config["stages"].values() for c, w in s["category_weights"].items() if w > 0}
    if lost := used - by_category.keys():
        raise ValueError(f"no source for {sorted(lost)}")


def data_of(config: dict[str, Any], stage: str) -> dict[str, Any]:
    """Data settings of a stage: its own values replace whole entries of the recipe's, which replace the defaults."""
    return DATA_DEFAULTS | config.get("data", {}) | config["stages"][stage].get("data", {})


def training_of(config: dict[str, Any], stage: str) -> dict[str, Any]:
    return config.get("training", {}) | config["stages"][stage].get("training", {})


def source_targets(config: dict[str, Any], stage: str) -> dict[str, int]:
    """Tokens to collect from each source of an active category."""
    own, data = config["stages"][stage], data_of(config, stage)
    weights = own["category_weights"]
    return {s["name"]: round(own["token_budget"] * weights[s["category"]] * s["source_weight"] * data["candidate_oversample"]) for s in config["sources"] if weights.get(s["category"], 0) > 0}
