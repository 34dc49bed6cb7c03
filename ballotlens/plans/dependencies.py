"""Which epochs of a dataset follow from which epochs of its source tables, and
what a run has to compute when source files change.

Source files are told apart by fingerprints per table and epoch folder (names,
sizes and times of their files; nothing of their content is read). A run stores
them in the manifest of each dataset; the next run computes the epochs whose
fingerprints differ, those never computed and the unsettled ones.

Relations of a source epoch M to a dataset epoch N:

* ``same``: N = M (the rows of the epoch themselves);
* ``later``: N >= M (as-of lookups and lookups of earlier proposals);
* ``all``: every N. All-time facts (first registration, latest owners). As in the
  original pipeline settled epochs keep the facts of the time they were written,
  unless ``all_time`` is asked for.
"""

from __future__ import annotations

from collections.abc import Iterable

from ballotlens.sources.tables import Tables

SAME, LATER, ALL = "same", "later", "all"

DEPENDS: dict[str, dict[str, str]] = {
    "drep_epoch_stats": {"drep_dist": SAME, "voting_procedure": SAME, "drep": LATER, "drep_registration": ALL},
    "pool_epoch_stats": {"pool": SAME, "voting_procedure": SAME, "pool_registration": ALL, "delegation_vote": ALL},
    "gov_action_votes": {"voting_procedure": SAME, "gov_action_proposal": LATER},
    "gov_action_lifecycle": {"gov_action_proposal": SAME, "gov_action_proposal_status": SAME},
    "epoch_summary": {"adapot": SAME, "block": SAME, "transaction": SAME, "epoch_stake": SAME, "drep_dist": SAME, "pool": SAME,
                      "gov_action_proposal": SAME, "gov_action_proposal_status": SAME, "drep_registration": SAME,
                      "committee_member": ALL, "committee": ALL},
    "delegation_events": {"delegation_vote": SAME},
    "cc_vote_details": {"voting_procedure": SAME, "gov_action_proposal": LATER, "committee_registration": ALL},
    "governance_params": {"epoch_param": SAME},
}

Fingerprints = dict[str, dict[str, str]]


def fingerprints_for(t: Tables, name: str) -> Fingerprints | None:
    """Fingerprints of the sources of dataset ``name``; None where one of them is
    not read from files (frames, fixtures)."""
    found = {}
    for table in DEPENDS[name]:
        prints = t.fingerprints(table)
        if prints is None:
            return None
        found[table] = prints
    return found


def changed_epochs(old: dict[str, str], new: dict[str, str]) -> set[str]:
    """Epoch folders that came, went or have other files."""
    return {e for e in set(old) | set(new) if old.get(e) != new.get(e)}


def pending_by_change(name: str, old: Fingerprints, new: Fingerprints, targets: Iterable[int], all_time: bool = False) -> set[int]:
    """Epochs of ``targets`` that follow from changed source epochs."""
    targets, pending = set(targets), set()
    for table, relation in DEPENDS[name].items():
        changed = changed_epochs(old.get(table, {}), new.get(table, {}))
        numbers = {int(e) for e in changed if e.lstrip("-").isdigit()}
        if not changed or (relation == ALL and not all_time):
            continue
        if relation == ALL or len(numbers) < len(changed):      # or files outside epoch folders: any epoch may follow
            pending |= targets
        elif relation == SAME:
            pending |= numbers & targets
        else:
            pending |= {n for n in targets if n >= min(numbers)}
    return pending
