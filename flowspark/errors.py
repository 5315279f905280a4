"""Errors that users can act on; code is stable, place names the source position if there is one."""

from __future__ import annotations


class FlowError(Exception):
    def __init__(self, message: str, code: str = "FLOW_ERROR", place: str | None = None, hint: str | None = None):
        super().__init__(message)
        self.message, self.code, self.place, self.hint = message, code, place, hint

    def as_dict(self) -> dict:
        return {"mensaje": self.message, "codigo": self.code, "ubicacion": self.place, "ayuda": self.hint}


class RecipeError(FlowError):
    pass


class ScriptError(FlowError):
    """One or more errors of a script; errors has them all."""

    def __init__(self, errors: list[FlowError]):
        super().__init__("; ".join(f"{e.code}: {e.message}" for e in errors), errors[0].code, errors[0].place)
        self.errors = errors
