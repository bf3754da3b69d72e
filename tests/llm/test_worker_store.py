"""A Python worker that goes on with another operator lets the last one's memory go."""

from __future__ import annotations

from touchline.llm import common


def test_a_worker_that_changes_owner_hands_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    common.worker_store("test-first")["model"] = [1]
    calls.clear()
    assert common.worker_store("test-first") == {"model": [1]} and not calls
    assert common.worker_store("test-second") == {} and len(calls) == 1
