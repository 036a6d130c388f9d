"""Safe repairs of model output, one way only, each with a record of what was changed."""

from __future__ import annotations

import copy
import json
from collections.abc import Iterator
from typing import NamedTuple

from evidentia.functions.similarity import THRESHOLD, best_ratio


class Repair(NamedTuple):
    kind: str  # paraphrase, page_range or method_id
    attempt: int
    json_path: str
    before: str
    after: str
    ratio: float | None = None


def child(path: str, key: str) -> str:
    return f"{path}.{key}" if key.isidentifier() else f"{path}[{json.dumps(key, ensure_ascii=False)}]"


def objects(value: object, path: str = "$") -> Iterator[tuple[dict, str]]:
    """Every object of a JSON value with its path, outer ones first."""
    if isinstance(value, dict):
        yield value, path
        for k, v in value.items():
            yield from objects(v, child(path, str(k)))
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from objects(v, f"{path}[{i}]")


def _whole(x: object) -> bool:
    return type(x) is int


def _renamed(payload: dict, attempt: int) -> Iterator[Repair]:
    taken: set[str] = set()
    times: dict[str, int] = {}
    lists = lambda x, key: x.get(key) if isinstance(x, dict) and isinstance(x.get(key), list) else []
    for q, question in enumerate(lists(payload, "research_questions")):
        for u, unit in enumerate(lists(question, "study_units")):
            for m, method in enumerate(lists(unit, "methods")):
                name = method.get("method_id") if isinstance(method, dict) else None
                if not isinstance(name, str) or not name:
                    continue
                times[name] = n = times.get(name, 0) + 1
                new = name
                while new in taken:
                    n = max(2, n)
                    new, n = f"{name}__dup{n}", n + 1
                taken.add(new)
                if new != name:
                    method["method_id"] = new
                    yield Repair("method_id", attempt, f"$.research_questions[{q}].study_units[{u}].methods[{m}].method_id", name, new)


def repaired(payload: dict, texts: dict[str, str], pages: dict[str, tuple[int, int]], attempt: int = 1) -> tuple[dict, list[Repair]]:
    """A copy of ``payload`` with repairs, and their list.

    A quotation whose ratio to its chunk is under the threshold is marked as retold; what
    is marked as retold stays so.  A page range of whole, not inverted numbers that leaves
    its chunk becomes the chunk's.  The second and later methods of a name get a suffix.
    Unknown chunks and malformed values are left to the validators.
    """
    payload = copy.deepcopy(payload)
    retold, moved = [], []
    for x, path in objects(payload):
        chunk, excerpt = x.get("chunk_id"), x.get("text_excerpt")
        if not isinstance(chunk, str) or "text_excerpt" not in x or "paraphrased" not in x:
            continue
        if x["paraphrased"] is False and isinstance(excerpt, str) and isinstance(texts.get(chunk), str):
            ratio = best_ratio(excerpt, texts[chunk])
            if ratio < THRESHOLD:
                retold.append((x, Repair("paraphrase", attempt, f"{path}.paraphrased", "false", "true", ratio)))
        first, last = x.get("page_start"), x.get("page_end")
        if chunk in pages and _whole(first) and _whole(last) and first <= last:
            low, high = pages[chunk]
            if first < low or last > high:
                moved.append((x, (low, high), Repair("page_range", attempt, path, f"{first}-{last}", f"{low}-{high}")))
    for x, _ in retold:
        x["paraphrased"] = True
    for x, (low, high), _ in moved:
        x["page_start"], x["page_end"] = low, high
    return payload, [r for _, r in retold] + [r for *_, r in moved] + list(_renamed(payload, attempt))


#: Codes and messages of repairs in a packet's warnings.
_MESSAGES = {
    "paraphrase": ("extraction.provenance_paraphrase_corrected", "An excerpt below the threshold was marked as retold."),
    "page_range": ("extraction.provenance_page_range_corrected", "A page range outside its chunk became the chunk's."),
    "method_id": ("extraction.duplicate_method_id_renamed", "A repeated method id was given a suffix."),
    "flat": ("extraction.flat_fallback", "Ids still clashed after all attempts; a flat extraction was used."),
}


def warnings(repairs: list[Repair], flat: bool = False) -> list[dict]:
    """Warnings of repairs: each once, in order."""
    out = []
    for r in repairs:
        code, message = _MESSAGES[r.kind]
        how = f"{r.before} -> {r.after}" + (f"; similarity {r.ratio:.4f}" if r.ratio is not None else "") + f" on attempt {r.attempt}"
        out.append((code, r.json_path, message, how))
    if flat:
        out.append((*_MESSAGES["flat"][:1], "$.research_questions[0].study_units[0]", _MESSAGES["flat"][1], "flattened into one unit"))
    return [{"code": c, "message": m, "json_path": p, "repair": h} for c, p, m, h in sorted(set(out))]
