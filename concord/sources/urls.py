"""Database URLs: protocol://[user[:password]@]host[:port]/database[/schema]."""

from __future__ import annotations

import re
from dataclasses import dataclass

PROTOCOLS = {"postgres": "postgresql"}
URL = re.compile(r"(?P<protocol>[a-z]+)://(?:(?P<user>[^:@/]*)(?::(?P<password>[^@/]*))?@)?(?P<host>\[[^\]]*\]|[^:/\[\]]*)(?::(?P<port>\d+))?/(?P<database>[^/]+)(?:/(?P<schema>[^/]+))?")


def url_decode(s: str) -> str:
    """%-escapes of two hexadecimal digits; all others are kept as they are."""
    return re.sub(rb"%([0-9A-Fa-f]{2})", lambda m: bytes([int(m[1], 16)]), s.encode()).decode("utf-8", "replace")


@dataclass(frozen=True)
class DbUrl:
    protocol: str
    host: str
    database: str
    user: str = ""
    password: str = ""
    port: str = ""
    schema: str = ""

    @property
    def jdbc(self) -> str:
        host = f"[{self.host}]" if ":" in self.host else self.host
        return f"jdbc:{self.protocol}://{host}{':' + self.port if self.port else ''}/{self.database}"


def parse_db_url(url: str) -> DbUrl:
    m = URL.fullmatch(url)
    if not m:
        raise ValueError("expected protocol://[user[:password]@]host[:port]/database[/schema]")
    parts = {k: url_decode(v or "") for k, v in m.groupdict().items()}
    parts["host"] = parts["host"].strip("[]")
    parts["protocol"] = PROTOCOLS.get(parts["protocol"], parts["protocol"])
    return DbUrl(**parts)
