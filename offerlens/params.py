"""Run parameters and the fixed values of the business rules."""

from __future__ import annotations

from dataclasses import dataclass, replace

# ---- Fixed values (must stay exactly as they are for right results) ----------
CYCLES_PER_YEAR = 18
ESTABLISHED = "E"
NEW = "N"
PERSONALISATION = 0
ESTIMATION = 1
NO_PROFILE = "X"
SHOWROOM = "SR"
DAILY_OFFER = "ODD"
SINGLE = "Individual"
BUNDLE = "Bundle"
VALID_PROFIT_KIND = "01"
EXCLUDED_OFFER_KINDS = ("030", "040", "051")
CATALOGUE_VEHICLES = ("REVISTA", "CATÁLOGO", "CATALOGO")
WEB_CHANNELS = ("WEB", "WMX")
BEHAVIOUR_NEW = "Nuevas"
BEHAVIOUR_CONSTANT = ("Constantes 1", "Constantes 2")
BEHAVIOUR_INCONSTANT = ("Inconstantes",)
GENERIC_SELLER = "XXXXXXXXX"
PORTAL_ZONE = "IDP"
# order in the daily offer -> start day, when no start day is configured
DEFAULT_START_DAY = {1: 0, 2: -1, 3: 1, 4: 2, 5: 3, 6: 4}
# interface order of the final offer list: rank -> order
FINAL_OFFER_ORDER = {3: 1, 1: 2, 2: 3}
TYPE_PRIORITY = {"T": 1, "N": 2, "F": 3}
HISTORY_CYCLES = 24          # established sellers
NEW_HISTORY_CYCLES = 18      # new sellers
RECENT_CYCLES = 6
NEVER_BOUGHT_RECENCY = 24
SCORE_EXPONENT_CAP = 700.0
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class RunParams:
    """One run: which cycle, which seller kind, which rule set."""

    process_cycle: int
    target_cycle: int
    kind: str = ESTABLISHED
    load: int = PERSONALISATION
    engine: int = 0                  # 1: rank by the gap-engine score
    profile: str = NO_PROFILE
    peer_grouping: int = 1           # 1: region + segment, otherwise: profile
    personalisation: str = SHOWROOM
    country: str = "C1"

    @property
    def start(self) -> int:
        """First cycle of the established history window."""
        return self.process_cycle - (HISTORY_CYCLES - 1)

    @property
    def recent_start(self) -> int:
        return self.process_cycle - (RECENT_CYCLES - 1)

    @property
    def new_start(self) -> int:
        return self.process_cycle - (NEW_HISTORY_CYCLES - 1)

    @property
    def peer_keys(self) -> list[str]:
        return ["region_id", "segment"] if self.peer_grouping == 1 else ["peer_profile"]

    def with_(self, **changes) -> "RunParams":
        return replace(self, **changes)
