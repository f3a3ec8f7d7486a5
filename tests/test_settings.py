import pytest

from tidemark.operators.evaluation import GateResult, gate
from tidemark.plans.store import decision_summary
from tidemark.settings import BadSetting, Settings


def test_settings():
    assert Settings.from_env({}) == Settings()
    got = Settings.from_env({"TIDEMARK_DELAY": "0.5", "TIDEMARK_RETRIES": "7", "TIDEMARK_UNREACHABLE": "a, b,", "TIDEMARK_DATA": "/x", "OTHER": "1"})
    assert (got.delay, got.retries, got.unreachable, got.data) == (0.5, 7, ("a", "b"), "/x")
    for name, value in (("RETRIES", "x"), ("PAUSE", "-1"), ("NOPE", "1")):
        with pytest.raises(BadSetting):
            Settings.from_env({f"TIDEMARK_{name}": value})


def test_summaries():
    got = gate({"ece": 0.2, "p95_ms": 10, "cost_per_1k": 0.01, "f1": {}}, None, None, "h", 10, 0)
    assert isinstance(got, GateResult) and got == ("REJECT", ["calibration error over 0.08", "under 150 test rows"])
    assert got.summary() == "REJECT\n  - calibration error over 0.08\n  - under 150 test rows"
    assert decision_summary({"at": 0, "artifact": "abc", "verdict": "HOLD", "reasons": ["x", "y"]}) == "1970-01-01 00:00 HOLD    abc: x; y"
    assert decision_summary({"at": 0, "artifact": "abc", "verdict": "PROMOTE"}) == "1970-01-01 00:00 PROMOTE abc"
