"""The one exception type: a stable code plus a few sample keys."""

from __future__ import annotations


class ContractError(Exception):
    """Raised when a contract check finds offending rows."""

    def __init__(self, code: str, detail: str = "") -> None:
        super().__init__(f"{code}: {detail}" if detail else code)
        self.code = code
        self.detail = detail
