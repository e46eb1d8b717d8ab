"""Save a fitted model and load it back under the class it was saved with."""

from __future__ import annotations


def save_model(model, path: str) -> str:
    """Each model gets its own path, so no save can overwrite another model."""
    model.write().overwrite().save(path)
    return path


def reload_model(model, path: str):
    """Load what ``save_model`` wrote, using the class of ``model`` itself."""
    return type(model).load(path)
