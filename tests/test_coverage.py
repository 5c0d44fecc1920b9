"""The README's coverage table names every inventory ID and every query."""

import re
from pathlib import Path

from comarca.queries import QUERIES

README = (Path(__file__).resolve().parent.parent / "README.md").read_text()

INVENTORY = {
    "SRC": 4, "SNK": 6, "PRJ": 11, "FLT": 11, "JON": 3, "AGG": 14, "SRT": 4, "SET": 3,
    "FN": 13, "ARR": 6, "DQ": 8, "PIP": 9, "Q": 20,
}


def listed_ids():
    found = set()
    for first, last in re.findall(r"\b([A-Z]+\d+)(?:-([A-Z]+\d+))?", README):
        prefix, start = re.fullmatch(r"([A-Z]+)(\d+)", first).groups()
        end = re.fullmatch(r"[A-Z]+(\d+)", last).group(1) if last else start
        found |= {f"{prefix}{n}" for n in range(int(start), int(end) + 1)}
    return found


def test_every_inventory_id_is_listed():
    wanted = {f"{prefix}{n}" for prefix, count in INVENTORY.items() for n in range(1, count + 1)}
    assert wanted - listed_ids() == set()


def test_every_query_is_listed_and_exists():
    named = set(re.findall(r"`(\w+)`", README))
    assert set(QUERIES) - named == set()
