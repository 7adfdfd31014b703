"""What is particular to one mailing list; everything else in the library is the same for all."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    """One list's archive.

    source: its name, used in paths, synthetic ids and permalinks.
    scheme: "permalink" (a page of its own for each message, or else for each day), "by_id" or "none".
    hop: pattern of host names of the list's own servers; None takes any Received header as evidence.
    day_url: Spark date pattern of the day page, for "permalink".
    id_url: prefix of a message's page, for "by_id".
    ranks: provenance values from best to worst; others come last.
    """

    source: str = "list"
    scheme: str = "permalink"
    hop: str | None = None
    day_url: str = "'https://archive.example.org/list/'yyyy/MM/dd"
    id_url: str = "https://archive.example.org/list/"
    ranks: tuple[str, ...] = ("maildir", "upstream", "scrape")
    default_provenance: str | None = None
    scraped: str = "scrape"

    @property
    def fallback_provenance(self) -> str:
        return self.default_provenance or ("maildir" if self.scheme == "permalink" else "upstream")
