"""Test doubles importable by Spark's Python workers."""


class FakeBackend:
    labels = ["negative", "neutral", "positive"]

    def predict_proba(self, texts):
        if any("poison" in t for t in texts):
            raise RuntimeError("boom")
        return [[0.1, 0.2, 0.7] for _ in texts]


def make_backend():
    return FakeBackend()
