"""Folder names of partition tuples, in one place for readers, loads and landings."""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import unquote

# What Hive-style folder names escape as %XX, and the folder of a null value.
_ESCAPED = re.compile(r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _escape(value: object) -> str:
    if value is None or value == "":
        return _NULL_FOLDER
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", str(value))


def hive_path(root: str, *folders: str, keys: Mapping[str, object] | None = None) -> str:
    """``root/folder/.../K1=v1/K2=v2``; empty folders and no keys add nothing."""
    inner = [f.strip("/") for f in folders]
    inner += [f"{_escape(k)}={_escape(v)}" for k, v in (keys or {}).items()]
    return "/".join([root.rstrip("/"), *(f for f in inner if f)])


def partition_values(spec: str) -> dict[str, str | None]:
    """Column values that a folder name ``K1=v1/K2=v2`` stands for."""
    parts = (part.partition("=") for part in spec.split("/"))
    return {unquote(k): None if v == _NULL_FOLDER else unquote(v) for k, _, v in parts}
