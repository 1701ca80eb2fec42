"""The download request: its predicate document, and a client with an injectable transport."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from ..schemas import ALLOWED_BASIS

POLL_SECONDS = 20
CHUNK = 8192

# The countries of the study extent.
COUNTRIES = "AT BE BG HR CY CZ DK EE FI FR DE GR HU IE IT LV LT LU MT NL PL PT RO SK SI ES SE IS NO CH LI GB".split()


@dataclass(frozen=True)
class Credentials:
    user: str
    password: str
    email: str

    @classmethod
    def from_environment(cls, prefix: str) -> Credentials:
        """From PREFIX_USER, PREFIX_PASSWORD and PREFIX_EMAIL; all three must be set."""
        found = [os.environ.get(f"{prefix}_{k}") for k in ("USER", "PASSWORD", "EMAIL")]
        if not all(found):
            raise ValueError(f"set {prefix}_USER, {prefix}_PASSWORD and {prefix}_EMAIL")
        return cls(*found)


def request_predicate(taxon_keys: Iterable[int], countries: Sequence[str] = COUNTRIES, basis: Sequence[str] = ALLOWED_BASIS, max_uncertainty: int = 1000) -> dict:
    """The predicate tree of a request; ``operators.predicates.predicate`` evaluates the same tree locally."""
    equals = lambda key, value: {"type": "equals", "key": key, "value": value}
    any_of = lambda key, values: {"type": "in", "key": key, "values": list(values)}
    return {
        "type": "and",
        "predicates": [
            {"type": "or", "predicates": [equals("TAXON_KEY", int(k)) for k in taxon_keys]},
            any_of("COUNTRY", countries),
            equals("HAS_COORDINATE", "TRUE"),
            equals("HAS_GEOSPATIAL_ISSUE", "FALSE"),
            {"type": "lessThan", "key": "COORDINATE_UNCERTAINTY_IN_METERS", "value": str(max_uncertainty)},
            any_of("BASIS_OF_RECORD", basis),
        ],
    }


def request_document(credentials: Credentials, predicate: dict, format: str = "DWCA") -> str:
    return json.dumps({"creator": credentials.user, "notificationAddresses": [credentials.email], "sendNotification": True, "format": format, "predicate": predicate})


#: (method, url, body) to (status, bytes or chunks of bytes)
Transport = Callable[[str, str, str | None], tuple[int, bytes | Iterable[bytes]]]


class DownloadClient:
    """Submit, wait and fetch, by whatever transport and clock it is given."""

    def __init__(self, base: str, transport: Transport, sleep: Callable[[float], None] = time.sleep):
        self.base, self.transport, self.sleep = base.rstrip("/"), transport, sleep

    def submit(self, document: str) -> str:
        status, body = self.transport("POST", f"{self.base}/request", document)
        if status == 201:
            return bytes(body).decode().strip()
        if status == 420:
            raise RuntimeError("too many downloads at once; try again later")
        raise RuntimeError(f"the request failed with status {status}")

    def wait(self, key: str, every: float = POLL_SECONDS) -> None:
        while True:
            _, body = self.transport("GET", f"{self.base}/{key}", None)
            said = json.loads(bytes(body))["status"]
            if said == "SUCCEEDED":
                return
            if said in ("FAILED", "CANCELLED", "KILLED"):
                raise RuntimeError(f"the download ended as {said}")
            self.sleep(every)

    def fetch(self, key: str, folder: str, dataset: str, today: date | None = None) -> str:
        """The archive as a dated ZIP in ``folder``, written chunk by chunk."""
        path = os.path.join(folder, f"{dataset}_{(today or date.today()):%Y%m%d}.zip")
        _, body = self.transport("GET", f"{self.base}/request/{key}.zip", None)
        os.makedirs(folder, exist_ok=True)
        with open(path, "wb") as out:
            for chunk in [body[i : i + CHUNK] for i in range(0, len(body), CHUNK)] if isinstance(body, bytes) else body:
                out.write(chunk)
        return path
