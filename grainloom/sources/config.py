"""Configuration: YAML with ${NAME:default} from the environment, dotted overrides, checks."""

from __future__ import annotations

import itertools
import math
import os
import random
import re
from collections.abc import Iterator, Mapping
from typing import Any

_VARIABLE = re.compile(r"\$\{([^}:]+)(?::([^}]*))?\}")


def interpolated(value: Any, environment: Mapping[str, str] | None = None) -> Any:
    """Variables in all strings, at any depth; one that is unset and has no default stays as it is written."""
    env = os.environ if environment is None else environment
    if isinstance(value, str):
        return _VARIABLE.sub(lambda m: env.get(m[1], m[0] if m[2] is None else m[2]), value)
    if isinstance(value, Mapping):
        return {k: interpolated(v, env) for k, v in value.items()}
    return [interpolated(v, env) for v in value] if isinstance(value, list) else value


def get(config: Mapping, path: str, default: Any = None) -> Any:
    at: Any = config
    for key in path.split("."):
        if not isinstance(at, Mapping) or key not in at:
            return default
        at = at[key]
    return at


def put(config: dict, path: str, value: Any) -> dict:
    *above, last = path.split(".")
    at = config
    for key in above:
        at = at.setdefault(key, {})
    at[last] = value
    return config


def load(path: str, overrides: Mapping[str, str] | None = None) -> dict:
    """Overrides stay strings."""
    import yaml

    with open(path) as f:
        config = interpolated(yaml.safe_load(f) or {})
    for k, v in (overrides or {}).items():
        put(config, k, v)
    return config


def checked(config: Mapping, bounds: Mapping[str, tuple[float, float]]) -> None:
    """Raises if a number at a dotted path is there and out of its bounds."""
    for path, (low, high) in bounds.items():
        value = get(config, path)
        if value is not None and not low <= float(value) <= high:
            raise ValueError(f"{path} = {value} is not within {low} and {high}")


def grid(parameters: Mapping[str, list], most: int | None = None, seed: int = 42) -> list[dict]:
    """All combinations, or `most` of them drawn without repetition."""
    every = [dict(zip(parameters, v, strict=True)) for v in itertools.product(*parameters.values())]
    return random.Random(seed).sample(every, most) if most and len(every) > most else every


def draws(parameters: Mapping[str, Any], n: int, seed: int = 42) -> Iterator[dict]:
    """Random settings: a list is chosen from, (low, high) is uniform, (low, high, "log") log-uniform; whole bounds give whole numbers."""
    rng = random.Random(seed)
    for _ in range(n):
        out = {}
        for name, p in parameters.items():
            if isinstance(p, list):
                out[name] = rng.choice(p)
            elif len(p) == 3:
                out[name] = math.exp(rng.uniform(math.log(p[0]), math.log(p[1])))
            else:
                out[name] = rng.randint(*p) if all(isinstance(x, int) for x in p) else rng.uniform(*p)
        yield out
