from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Model:
    """Column names of facts, change log and rate lines.

    The defaults are the tax model: facts keyed by ``cuit`` with a change log of
    merchants. Maps go from the input column to the rate line column.
    """

    key: str = "cuit"
    group: tuple[str, ...] = ("tax_id",)
    rate: str = "tax_rate"
    measures: dict[str, str] = field(
        default_factory=lambda: {"base_tax": "total_base_tax", "tax_amount": "total_tax_amount"}
    )
    attributes: dict[str, str] = field(
        default_factory=lambda: {"establishment": "establishment", "name": "merchant_name"}
    )
    event_time: str = "created_at"
    arrival: tuple[str, ...] = ("id",)
    family_column: str = "tax_id"
    family: str = "RET_"

    @property
    def groups(self) -> list[str]:
        """Everything but the period that identifies a rate line."""
        return [self.key, *self.group, self.rate]

    @property
    def line_keys(self) -> list[str]:
        return [self.key, *self.group, "window_start", self.rate]

    @property
    def line_columns(self) -> list[str]:
        return [*self.line_keys, *self.attributes.values(), "window_end", *self.measures.values()]


TAXES = Model()
