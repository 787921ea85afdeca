"""The tree of path templates against a plain version."""

import math
import random
from collections import Counter

import pytest

from asterism.llm import urls


def plain(pages, levels):
    """Template and purity of each (host, path), level by level."""
    template = {(host, path): "" for host, path, _ in pages}
    segments = {(host, path): [s for s in path.split("/") if s] for host, path, _ in pages}

    def segment(at, level):
        parts = segments[at]
        return None if len(parts) <= level else parts[level] if level < levels - 1 else "/".join(parts[level:])

    for level in range(levels):
        count, labelled, bad = Counter(), Counter(), Counter()
        for host, path, label in pages:
            part = segment((host, path), level)
            if part is not None:
                for node in ((host, template[host, path]), (host, template[host, path], part)):
                    count[node] += 1
                    labelled[node] += label is not None
                    bad[node] += label or 0
        grown = {}
        for at, before in template.items():
            part = segment(at, level)
            if part is None:
                grown[at] = before
                continue
            parent, node = (at[0], before), (at[0], before, part)
            own = False
            if count[node] >= urls.LEAST_ROWS and count[node] >= urls.LEAST_SHARE * count[parent]:
                rest, rest_bad = labelled[parent] - labelled[node], bad[parent] - bad[node]
                if labelled[node] and rest:
                    pooled = bad[parent] / labelled[parent]
                    error = math.sqrt(pooled * (1 - pooled) * (1 / labelled[node] + 1 / rest))
                    own = error > 0 and abs(bad[node] / labelled[node] - rest_bad / rest) > urls.DIFFERENT * error
            grown[at] = f"{before}/{part if own else urls.WILDCARD}"
        template = grown
    labelled, bad = Counter(), Counter()
    for host, path, label in pages:
        node = (host, template[host, path])
        labelled[node] += label is not None
        bad[node] += label or 0
    prior = sum(bad.values()) / sum(labelled.values()) if sum(labelled.values()) else 0.0
    return {at: (template[at], (bad[at[0], template[at]] + urls.PRIOR_ROWS * prior) / (labelled[at[0], template[at]] + urls.PRIOR_ROWS)) for at in template}


@pytest.fixture
def judged(spark):
    def run(pages, **how):
        rows = [(i, f"http://{host}{path}", label, "x", 9.0) for i, (host, path, label) in enumerate(pages)]
        df = spark.createDataFrame(rows, "page_id long, url string, bad int, template string, purity double")
        return {row["page_id"]: row for row in urls.judged(df, [], **how).collect()}

    return run


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_templates_and_purity(judged, levels):
    rng = random.Random(levels)
    pages = []
    for _ in range(600):
        host, kind = rng.choice(["a.example", "b.example"]), rng.choice(["news", "spam", "user", "x"])
        path = "/" + "/".join([kind, *[rng.choice(["p", "q", str(rng.randrange(500))]) for _ in range(rng.randrange(4))]])
        label = rng.choice([None, int(kind == "spam" or rng.random() < 0.1)])
        pages.append((host, path, label))
    pages += [pages[0]] * 20 + [("", "", None), ("c.example", "/", 1), ("c.example", "//", 0)]
    want = plain(pages, levels)
    got = judged(pages, levels=levels)
    assert len(got) == len(pages)
    for i, (host, path, _) in enumerate(pages):
        template, purity = want[host, path]
        assert got[i]["template"] == template and got[i]["purity"] == pytest.approx(purity)
        assert got[i]["verdict"] == ("block" if purity >= urls.REJECTED else "allow")
    assert any("spam" in row["template"] for row in got.values())


def test_without_labels(judged):
    got = judged([("a.example", f"/x/{i % 7}", None) for i in range(50)])
    assert {(row["template"], row["purity"], row["verdict"]) for row in got.values()} == {("/*/*", 0.0, "allow")}
