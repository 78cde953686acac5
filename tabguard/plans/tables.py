"""The eleven tables: universe, leaf cells, subtotals. Rules are SQL text over the joined record.

Record columns: RTYPE_PERSON, QAGE, CENHISP, CENRACE, RELSHIP of the person; RTYPE_UNIT, FINAL_POP,
HHSPAN, HHRACE, TEN, HHT, HHT2, CPLT of the unit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Relationship codes of family members, of own children, of the householder's partner
# and nonrelatives, and of other relatives.
FAMILY = "('20','21','23','25','26','27','28','29','30','31','32','33')"
OWN_CHILD = "('25','26','27')"
PARTNER_OR_NONRELATIVE = "('20','21','22','23','24','34','35','36')"
OTHER_RELATIVE = "('28','29','31','32','33')"

PERSON_UNIVERSES = {
    "in_units": "RTYPE_PERSON = '3'",
    "minors": "RTYPE_PERSON = '3' AND QAGE < 18",
    "family": f"RELSHIP IN {FAMILY}",
    "own_children": f"RELSHIP IN {OWN_CHILD} AND QAGE < 18",
}
"""Person filters. They come before the truncation, so a household is cut for each of them."""

UNIT_UNIVERSES = {
    "households": "RTYPE_UNIT = '2' AND HHT <> '0'",
    "families": "HHT IN ('1','2','3')",
}

_ADULT = [("QAGE < 18", 2), ("QAGE >= 18", 3)]
_TENURE = [("TEN = '1'", 2), ("TEN = '2'", 3), ("TEN IN ('3','4')", 4)]
_OWNER = [("TEN IN ('1','2')", 2), ("TEN IN ('3','4')", 3)]
_HOUSEHOLD_TYPE = [
    ("HHT2 IN ('01','02') AND CPLT = '1'", 3),
    ("HHT2 IN ('01','02') AND CPLT = '2'", 4),
    ("HHT2 IN ('03','04') AND CPLT = '3'", 6),
    ("HHT2 IN ('03','04') AND CPLT = '4'", 7),
    ("HHT2 = '09'", 9),
    ("HHT2 IN ('10','11','12')", 10),
    ("HHT2 = '05'", 12),
    ("HHT2 IN ('06','07','08')", 13),
]
_RELATIONSHIP = [
    (f"RELSHIP IN {PARTNER_OR_NONRELATIVE}", 2),
    (f"RELSHIP IN {OWN_CHILD} AND HHT2 = '01'", 4),
    (f"RELSHIP IN {OWN_CHILD} AND HHT2 = '03'", 5),
    (f"RELSHIP IN {OWN_CHILD} AND HHT2 = '10'", 6),
    (f"RELSHIP IN {OWN_CHILD} AND HHT2 = '06'", 7),
    ("RELSHIP = '30'", 9),
    (f"RELSHIP IN {OTHER_RELATIVE}", 10),
]
_AGE_BANDS = ["QAGE < 4", "QAGE BETWEEN 4 AND 5", "QAGE BETWEEN 6 AND 11", "QAGE >= 12"]
_FAMILY_KINDS = {"01": 2, "03": 7, "10": 12, "06": 17}
_CHILD_AGES = [
    (f"HHT2 = '{kind}' AND {band}", parent + 1 + i)
    for kind, parent in _FAMILY_KINDS.items()
    for i, band in enumerate(_AGE_BANDS)
]


@dataclass(frozen=True)
class Table:
    """A table over persons or units.

    ``leaves`` are (condition, cell), first match wins. ``parents`` maps leaf to subtotal. The exact
    form adds ``fallbacks`` for records that reach a subtotal or the total only, and may count under a
    wider filter ``exact_filter``. ``race`` / ``ethnicity`` drive the iterations (none for two tables).
    """

    name: str
    cell: str
    universe: str
    leaves: tuple
    parents: dict = field(default_factory=dict)
    fallbacks: tuple = ()
    race: str | None = "HHRACE"
    ethnicity: str | None = "HHSPAN"
    unit_filter: str = "true"
    exact_filter: str = "true"
    derived_from: str | None = None

    @property
    def of_units(self) -> bool:
        return self.universe in UNIT_UNIVERSES

    @property
    def leaf_cells(self) -> list[int]:
        return list(dict.fromkeys(cell for _, cell in self.leaves))


_HH = "RTYPE_UNIT = '2' AND HHT <> '0'"
_FAM = "HHT IN ('1','2','3')"

TABLES = {
    t.name: t
    for t in [
        Table("PH1_num", "PH1_NUM_DATA_CELL", "in_units", tuple(_ADULT), exact_filter=_HH),
        Table("PH1_denom", "PH1_DENOM_DATA_CELL", "households", (("true", 1),)),
        Table(
            "PH2",
            "PH2_DATA_CELL",
            "in_units",
            tuple(_HOUSEHOLD_TYPE),
            {3: 2, 4: 2, 6: 5, 7: 5, 9: 8, 10: 8, 12: 11, 13: 11},
            (("HHT2 IN ('01','02')", 2), ("HHT2 IN ('03','04')", 5), ("true", 1)),
            race=None,
            ethnicity=None,
        ),
        Table(
            "PH3",
            "PH3_DATA_CELL",
            "minors",
            tuple(_RELATIONSHIP),
            {4: 3, 5: 3, 6: 3, 7: 3, 9: 8, 10: 8},
            ((f"RELSHIP IN {OWN_CHILD}", 3), ("true", 1)),
            race="CENRACE",
            ethnicity="CENHISP",
        ),
        Table(
            "PH4",
            "PH4_DATA_CELL",
            "family",
            tuple(_ADULT),
            unit_filter="HHT <= '3'",
            exact_filter=_FAM,
        ),
        Table("PH5_num", "PH5_NUM_DATA_CELL", "family", tuple(_ADULT), derived_from="PH4"),
        Table("PH5_denom", "PH5_DENOM_DATA_CELL", "families", (("true", 1),)),
        Table(
            "PH6",
            "PH6_DATA_CELL",
            "own_children",
            tuple(_CHILD_AGES),
            {p + 1 + i: p for p in _FAMILY_KINDS.values() for i in range(4)},
            (("true", 1),),
            race=None,
            ethnicity=None,
        ),
        Table("PH7", "PH7_DATA_CELL", "in_units", tuple(_TENURE)),
        Table("PH8_num", "PH8_NUM_DATA_CELL", "households", tuple(_OWNER), derived_from="PH7"),
        Table("PH8_denom", "PH8_DENOM_DATA_CELL", "households", tuple(_OWNER)),
    ]
}
COUNTED = [name for name, t in TABLES.items() if t.derived_from is None]
"""Tables that are counted; the other two follow from them and spend nothing."""
WITH_TAU = [name for name in COUNTED if not TABLES[name].of_units]
