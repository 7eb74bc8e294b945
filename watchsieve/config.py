"""Settings of a screening run."""

from __future__ import annotations

import configparser
from dataclasses import dataclass, field, replace
from pathlib import Path


@dataclass(frozen=True)
class ScreeningConfig:
    """Thresholds are shares from 0 to 1. Settings marked inert are read and kept, and nothing uses them."""

    person_jw: float = 0.85
    org_jw: float = 0.85
    org_aka_jw: float = 0.85
    address_jw: float = 0.70
    linked_person_jw: float = 0.85
    keep_chars: str = "-#"
    blocking: str = "letters"  # or "letters+phonetic", or "none"
    strict_reference: bool = False  # names that only ORG_NAME has are then not screened
    restrict_to_matched_party: bool = False  # addresses of other listed parties are then not compared
    match_scores: dict[str, float] = field(default_factory=lambda: {"Direct": 4, "Jaro-Winkler": 3, "Edit Distance": 2, "Double-Metaphone": 2, "NYSIIS": 2, "Soundex": 1})
    use_phonetic: bool = False  # inert
    max_addr_candidates: int = 50  # inert but for operators.legacy.address_candidates
    org_edit: float = 0.85  # inert
    org_aka_edit: float = 0.5  # inert


_INI = {
    "person_jw": ("IndividualMatch", "JaroWinklerMatchThreshold"),
    "org_jw": ("OrgNameMatch", "JaroWinklerMatchThreshold"),
    "org_aka_jw": ("OrgNameMatch", "JaroWinklerMatchThreshold_AKA"),
    "org_edit": ("OrgNameMatch", "EditDistanceMatchThreshold"),
    "org_aka_edit": ("OrgNameMatch", "EditDistanceMatchThreshold_AKA"),
    "address_jw": ("AddressMatch", "min_jw_similarity"),
}


def load_config(path: str | Path | None = None) -> ScreeningConfig:
    """The defaults, changed by what an INI file says; a missing file or setting leaves them."""
    made, ini = ScreeningConfig(), configparser.ConfigParser()
    ini.optionxform = str
    if path is None or not ini.read(path, encoding="utf-8-sig"):
        return made
    changes: dict = {k: ini.getfloat(*at) for k, at in _INI.items() if ini.has_option(*at)}
    if ini.has_option("Normalization", "keep_chars"):
        changes["keep_chars"] = ini.get("Normalization", "keep_chars").strip()
    if ini.has_option("Matching", "use_phonetic"):
        changes["use_phonetic"] = ini.getboolean("Matching", "use_phonetic")
    if ini.has_option("AddressMatch", "max_addr_candidates"):
        changes["max_addr_candidates"] = ini.getint("AddressMatch", "max_addr_candidates")
    if ini.has_section("MatchTypeScores"):
        changes["match_scores"] = made.match_scores | {k: float(v) for k, v in ini.items("MatchTypeScores")}
    return replace(made, **changes)
