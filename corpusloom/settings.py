"""Thresholds and limits as one value that operators take; nothing reads the environment."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Settings:
    min_raw_chars: int = 100
    min_clean_chars: int = 100
    min_main_chars: int = 250
    min_quality: float = 0.70
    max_ad_signals: int = 3
    language_threshold: float = 0.02
    min_keywords: int = 1
    min_record_words: int = 75
    domain_cap: int = 50
    whitelisted_cap: int = 5000
    retry_attempts: int = 3
    retry_seconds: float = 10.0
    retry_jitter: float = 5.0
    max_pagination: int = 5
    spider_links: int = 60
    max_sitemaps: int = 200
    max_pages: int = 5000
    max_pdfs: int = 5
    max_site_queries: int = 400
    pages_per_query: int = 3
    pages_per_focused_query: int = 1
    #: A file of byte-pair ranks; without one, tokens count as 0.
    tokenizer_ranks: str = ""

    @classmethod
    def of(cls, values: dict[str, str]) -> Settings:
        """From text, as an ``.env`` file has it; unknown keys are passed over."""
        known = {f.name: f for f in fields(cls)}
        typed = {k.lower(): type(getattr(cls(), k.lower()))(v) for k, v in values.items() if k.lower() in known}
        return replace(cls(), **typed)

    def cap(self, whitelisted: bool) -> int:
        return max(self.domain_cap, self.whitelisted_cap) if whitelisted else self.domain_cap
