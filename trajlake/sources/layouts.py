"""Which manifest and verdict file belong to a trajectory file, as data."""

from __future__ import annotations

from .jsonl import Layout

# Prefixes of trajectory files and their families.
FAMILIES = {"qwen3.6-27B_": "qwen3.6-27b", "deepseek_": "deepseek-v4-pro", "glm52_": "glm-5.2", "qwen37max_": "qwen3.7-max"}
# Manifests by prefix of the trajectory file; those of the last prefix go by the number after _v.
MANIFESTS = [
    ("qwen3.6-27B_", "manifest.jsonl"),
    ("deepseek_", "trajectories_deepseek_v15_manifest.jsonl"),
    ("glm52_", "trajectories_glm52_v15_manifest.jsonl"),
    ("qwen37max_", "trajectories_qwen37max_manifest.jsonl", "15"),
    ("qwen37max_", "trajectories_qwen37max_v{suffix}_manifest.jsonl"),
]
# Verdict files of the two layouts, in the order in which they are tried.
FIXED_VERDICTS = {
    "qwen3.6-27B_": ["qwen3.6-27B_sft_all_fixed.jsonl"],
    "deepseek_": ["aliyun-deepseek-v4-pro_v15_fixed.jsonl"],
    "glm52_": ["aliyun-glm-5.2_v15_fixed.jsonl"],
    "qwen37max_": ["aliyun-qwen3.7-max_v{suffix}_fixed.jsonl"],
}
UPSTREAM_NAMES = {"qwen3.6-27B_": "qwen3.6-27B", "deepseek_": "aliyun-deepseek-v4-pro", "glm52_": "aliyun-glm-5.2", "qwen37max_": "aliyun-qwen3.7-max"}


def _layout(verdicts: dict[str, list[str]]) -> Layout:
    return Layout([(prefix, manifest, verdicts[prefix], *only) for prefix, manifest, *only in MANIFESTS])


LAYOUTS = {
    "fixed": _layout(FIXED_VERDICTS),
    "upstream_openai": _layout({p: [f"{n}_{{version}}_openai.jsonl", f"{n}_v{{suffix}}_openai.jsonl"] for p, n in UPSTREAM_NAMES.items()}),
}


def layout(name: str | Layout) -> Layout:
    """The layout of a name, or the given one; ValueError for an unknown name."""
    if isinstance(name, Layout):
        return name
    if name not in LAYOUTS:
        raise ValueError(f"unknown verdict layout {name}")
    return LAYOUTS[name]
