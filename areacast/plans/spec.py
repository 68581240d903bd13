"""Column names of the jobs. The defaults are those of the case, area and weather files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from areacast.fixed import ALIASES, STATIONS


@dataclass(frozen=True)
class BaseSpec:
    # Fixed values -- column names of the files and of the base.
    area: str = "no_bairro_residencia"
    week: str = "ds_semana_notificacao"
    onset: str = "dt_diagnostico_sintoma"
    source: str = "source_dados"
    label: str = "resposta"
    kind: str = "ds_tipo_base"
    dim_area: str = "bairro"
    station: str = "estacao"
    population: str = "populacao"
    obs_station: str = "nome_estacao"
    obs_date: str = "data"
    measures: tuple[str, ...] = ("temp_maxima", "temp_minima", "temp_comp_media")
    stations: Mapping[str, str] = field(default_factory=lambda: dict(STATIONS))
    aliases: Mapping[str, str] = field(default_factory=lambda: dict(ALIASES))
    # What a station column holds: the share of the area's rows of the week, or the area's rows of the
    # whole period. Training, batch, forms and streams follow it, and a saved model names it.
    station_encoding: str = "share"

    def __post_init__(self):
        if self.station_encoding not in ("share", "count"):
            raise ValueError(f"station_encoding is share or count, not {self.station_encoding}")

    @property
    def means(self) -> list[str]:
        """Columns that are imputed and averaged."""
        return [self.population, *self.measures]

    @property
    def features(self) -> list[str]:
        """Model inputs, in the order of the vector."""
        return [*self.means, *self.stations.values()]

    @property
    def base_columns(self) -> list[str]:
        return [self.area, self.week, self.label, *self.features, self.kind]
