import pytest

from surgemark.config import EngineConfig
from surgemark.plans.detection import attach_why, detect_anomalies, why_for
from tests.conftest import make_events

CFG = EngineConfig(zscore_threshold=3.0, ewma_threshold=3.0)


def spike(spark):
    rows = []

    def add(t, domain, subject, actor, bot=False):
        rows.append({"t": t, "subject": subject, "actor": actor, "bot": bot, "bytes_delta": 50, "dims": {
            "domain": domain, "lang": domain.split(".")[0], "kind": "edit", "namespace": "0",
            "user_type": "bot" if bot else "human"}})

    for w in range(24):
        for i in range(10 + w % 5 - 2):
            add(1000 + w, f"d{i % 5}.wikipedia.org", f"P{i}", f"u{i}")
    for i in range(200):
        add(1024, "en.wikipedia.org", f"S{i}", f"bot{i % 3}", True)
    return make_events(spark, rows)


@pytest.mark.parametrize("staged", [True, False])
def test_spike_is_detected_and_explained(spark, staged):
    d = detect_anomalies(spike(spark), CFG.with_(detectors=("zscore", "ewma", "hst"), unavailable=("hst",)),
                         flush_to=1025.0, staged=staged)
    assert d.windows.count() == 25
    (a,) = d.anomalies.collect()
    assert a.metric == "rate" and a.value >= 150 and a.expected < 50
    assert a.agreement >= 2 and a.severity == "critical" and a.score >= 0.85
    assert {x.name for x in a.detectors if x.flag} == {"zscore", "ewma"}
    top = max((c for c in a.why if c.dim == "domain"), key=lambda c: c.excess)
    assert top.value == "en.wikipedia.org" and top.share > 0.5


def test_three_detectors_still_see_the_spike(spark):
    d = detect_anomalies(spike(spark), CFG)
    assert d.anomalies.count() == 1 and d.results.count() == 75


def test_pruned_and_full_dimension_scan_agree(spark):
    ev = spike(spark)
    d = detect_anomalies(ev, CFG)
    full = attach_why(d.anomalies.drop("why"), why_for(d.anomalies, ev, CFG))
    order = lambda df: sorted(tuple(r) for r in df.select("id", "why").collect())
    assert order(d.anomalies) == order(full)
