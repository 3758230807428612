"""The library never brings data rows to the driver.

Allowed driver round trips are metadata-sized: two scalar bounds for generated series and
calendars, the distinct partition values a partitioned upsert touches, and
catalog listings. Existence probes (``isEmpty``) bring a yes or no.
"""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1] / "strata"
ALLOWED = {
    ("sources/series.py", ".first()"),
    ("sinks/tables.py", ".collect()"),  # touched partition values / SHOW PARTITIONS
}
PATTERN = re.compile(r"\.(collect|toPandas|toLocalIterator|take|head|first|count)\(\)")


def test_no_row_collection_in_library():
    found = set()
    for path in ROOT.rglob("*.py"):
        rel = str(path.relative_to(ROOT))
        if rel.startswith("llm/"):
            continue  # optional part; what its operators collect is bounded and said in their modules
        for m in PATTERN.finditer(path.read_text()):
            found.add((rel, m.group(0)))
    assert found <= ALLOWED, sorted(found - ALLOWED)
