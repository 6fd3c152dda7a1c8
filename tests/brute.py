"""Literal one-row-at-a-time versions of operators, as second oracles on small inputs."""

from __future__ import annotations


def trunc_rate(value: int, weight: int) -> int:
    return 0 if weight == 0 else int(value / (weight / 1000.0))


def top_share(rows: list[tuple[int, int]], share: float = 0.25) -> tuple[int, int, int, int]:
    """Weight, value and rate of the best share of (weight, value) rows, and the rate of all."""
    ordered = sorted(rows, key=lambda r: (-trunc_rate(r[1], r[0]), -r[0], -r[1]))
    all_w, all_v = sum(w for w, _ in rows), sum(v for _, v in rows)
    left, top_w, top_v = all_w * share, 0, 0
    for w, v in ordered:
        if left - w < 0:
            top_w += int(left)
            top_v += int(v * (left / w))
            break
        left -= w
        top_w += w
        top_v += v
    return top_w, top_v, trunc_rate(top_v, top_w), trunc_rate(all_v, all_w)


def walk(events: list[str], table: dict[str, tuple[str, str]], start: str) -> int | None:
    """Index of the first illegal event, or None."""
    state = start
    for i, event in enumerate(events):
        if event not in table or table[event][0] != state:
            return i
        state = table[event][1]
    return None
