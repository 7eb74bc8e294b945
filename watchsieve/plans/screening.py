"""A whole screening run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..config import ScreeningConfig
from ..durable import held
from ..operators import audit, passes, report, score, summary
from ..sinks import Store
from ..sources.watchlist import WatchList


@dataclass
class Screening:
    person: DataFrame
    aka: DataFrame
    org: DataFrame
    org_near: DataFrame
    org_aka: DataFrame
    org_aka_near: DataFrame
    linked: DataFrame
    phone: DataFrame
    unmatched: DataFrame
    address: DataFrame
    gate_passing: DataFrame
    person_summary: DataFrame
    org_summary: DataFrame
    report: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "MatchingResults_Person_Full": self.person, "MatchingResults_AKA": self.aka, "MatchingResults_OrgName": self.org, "MatchingResults_OrgName_NoMatch": self.org_near, "MatchingResults_OrgName_AKA": self.org_aka,
            "MatchingResults_OrgName_AKA_NoMatch": self.org_aka_near, "MatchingResults_LinkedTo": self.linked, "MatchingResults_Phone": self.phone, "MatchingResults_NoMatch": self.unmatched, "MatchingResults_Address": self.address,
            "MatchingResults_GatePassing": self.gate_passing, "Matching_Summary_Person": self.person_summary, "Matching_Summary_Org": self.org_summary, "Report": self.report,
        }


def screen(records: DataFrame, watch: WatchList, config: ScreeningConfig = ScreeningConfig(), store: Store | None = None, run_id: int | None = None) -> Screening:  # noqa: B008
    """records: of sources.inputs.normalized, with record_id. With a store each pass is written once and later steps read its rows; without one it is cached."""
    run = run_id or (store.next_run() if store else 1)
    if store is not None:
        store.log_run(run, person=config.person_jw, org=config.org_jw, address=config.address_jw, blocking=config.blocking)

    def kept(name: str, df: DataFrame) -> DataFrame:
        if store is None:
            return held(df)
        store.replace_run(name, df, run)  # a run that is repeated after a failure replaces its rows
        return store.read(name, run).drop("Run_ID")

    person = kept("MatchingResults_Person_Full", passes.person_primary(records, watch.entries, config))
    aka = kept("MatchingResults_AKA", passes.person_aka(records, watch.akas, config))
    org, org_near = (kept(n, d) for n, d in zip(("MatchingResults_OrgName", "MatchingResults_OrgName_NoMatch"), passes.org_primary(records, watch.entries, config), strict=True))
    org_aka, org_aka_near = (kept(n, d) for n, d in zip(("MatchingResults_OrgName_AKA", "MatchingResults_OrgName_AKA_NoMatch"), passes.org_aka(records, watch.akas, config), strict=True))
    linked = kept("MatchingResults_LinkedTo", passes.linked_to(records, watch.remarks, config))
    phone = kept("MatchingResults_Phone", passes.phone(records, watch.phones))
    found = (person, aka, org, org_aka, linked, phone)
    unmatched = kept("MatchingResults_NoMatch", passes.no_match(records, *found))
    matched = found[0].select("Input_Record_ID", "SDN_UID")
    for d in found[1:]:
        matched = matched.union(d.select("Input_Record_ID", "SDN_UID"))
    address = kept("MatchingResults_Address", passes.address(records, watch.addresses, matched.distinct(), config))
    names = audit.passing_names(person, aka, (org, org_near), (org_aka, org_aka_near))
    rows = audit.gate_passing(names, records, watch.entries, watch.addresses)
    gate = kept("MatchingResults_GatePassing", score.composite(rows, watch.names(), strict_reference=config.strict_reference))
    one = kept("Matching_Summary_Person", summary.person_summary(person, aka, linked, address, unmatched))
    two = kept("Matching_Summary_Org", summary.org_summary(org, org_aka, linked, address, unmatched))
    whole = kept("Report", report.report(person, aka, org, org_aka, linked, phone, address))
    if store is not None:
        store.update_run(run, records=records.count(), person=config.person_jw, org=config.org_jw, address=config.address_jw, blocking=config.blocking)
    return Screening(person, aka, org, org_near, org_aka, org_aka_near, linked, phone, unmatched, address, gate, one, two, whole)
