"""Chat templates over an array of (role, content) messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands before and after a message of each role, and before all of them.
TEMPLATES = {
    "chatml": {"system": ("<|im_start|>system\n", "<|im_end|>\n"), "user": ("<|im_start|>user\n", "<|im_end|>\n"), "assistant": ("<|im_start|>assistant\n", "<|im_end|>\n"), "bos": ""},
    "llama": {
        "system": ("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\n", "<|eot_id|>"), "user": ("<|start_header_id|>user<|end_header_id|>\n\n", "<|eot_id|>"),
        "assistant": ("<|start_header_id|>assistant<|end_header_id|>\n\n", "<|eot_id|>"), "bos": "<|begin_of_text|>",
    },
    "alpaca": {"system": None, "user": ("### Instruction:\n", "\n\n### Response:\n"), "assistant": ("", "\n\n"), "bos": ""},
    "vicuna": {"system": ("", "\n\n"), "user": ("USER: ", "\n"), "assistant": ("ASSISTANT: ", "</s>\n"), "bos": ""},
}


def rendered(messages: Column, template: str) -> Column:
    """All messages in order. A missing role is the user's, one the template doesn't know is left out."""
    if template not in TEMPLATES:
        raise ValueError(f"unknown template {template}; there are {sorted(TEMPLATES)}")
    form = TEMPLATES[template]

    def one(m: Column) -> Column:
        role, content = F.coalesce(m["role"], F.lit("user")), F.coalesce(m["content"], F.lit(""))
        out = F.lit("")
        for name in ("system", "user", "assistant"):
            if form[name] is not None:
                before, after = form[name]
                out = F.when(role == name, F.concat(F.lit(before), content, F.lit(after))).otherwise(out)
        return out

    return F.concat(F.lit(form["bos"]), F.array_join(F.transform(messages, one), ""))


def pair(instruction: Column, response: Column, system: Column | None = None) -> Column:
    """Messages of one instruction and response, with a system message where it isn't empty."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    both = F.array(message("user", instruction), message("assistant", response))
    if system is None:
        return both
    return F.when(F.coalesce(system, F.lit("")) != "", F.concat(F.array(message("system", system)), both)).otherwise(both)
