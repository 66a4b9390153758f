"""Models that answer from a hash of the pixels."""

import hashlib

import numpy as np


def _seed(a: np.ndarray, salt: str) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.sha256(salt.encode() + np.ascontiguousarray(a).tobytes()).digest()[:8], "little"))


class StandIn:
    """Answers every stage from a hash of the pixels."""

    def detect(self, image):
        h, w = image.shape[:2]
        r = _seed(image, "detect")
        out = []
        for _ in range(int(r.integers(0, 3))):
            x, y = sorted(r.uniform(0, w, 2)), sorted(r.uniform(0, h, 2))
            out.append(([x[0], y[0], x[1], y[1]], float(r.uniform(0.3, 1))))
        return out

    def probabilities(self, crop, n: int = 5):
        p = _seed(crop, "class").dirichlet(np.ones(n))
        return p.tolist()

    def embed(self, crop):
        v = _seed(crop, "embed").normal(size=512)
        return (v / np.linalg.norm(v)).tolist()

    def caption(self, crop, prompt):
        return f"An element of {crop.shape[1]} by {crop.shape[0]} pixels.", [{"token": "An", "logprob": -0.1, "top_logprobs": []}]


class Orienter(StandIn):
    def probabilities(self, crop, n: int = 4):
        return super().probabilities(crop, n)


class Broken(StandIn):
    def caption(self, crop, prompt):
        raise TimeoutError
