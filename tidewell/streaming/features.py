"""Feature extraction as a stage's work: models plug in by one protocol."""

from __future__ import annotations

from typing import Protocol

import numpy as np


class Extractor(Protocol):
    """Embeds the contents of photos. None stands for one that can't be decoded."""

    def embed(self, contents: list[bytes]) -> list[np.ndarray | None]: ...


def embedding_work(extractor: Extractor, content: str = "content", key: str = "image_url_large"):
    """A stage's work: (key, cls_fp16, cls_shape, error)."""

    def work(rows: list[dict]) -> list[dict]:
        vectors = extractor.embed([r[content] or b"" for r in rows])
        return [{key: r[key], "cls_fp16": None if v is None else v.tobytes(), "cls_shape": None if v is None else list(v.shape), "error": None if v is not None else "undecodable"} for r, v in zip(rows, vectors, strict=True)]

    return work
