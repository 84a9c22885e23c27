"""Declarative table specifications: column rules, targets, keys and per-table checks.

A spec is plain data on the driver. Operators turn it into one ``select`` of Column
expressions, so adding a column never adds a pass over the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# rule kinds of a column
DATE = "date"            # clean_date -> DateType
DATE_TEXT = "date_text"  # clean_date rendered as ISO text
INT = "int"              # clean_int
CODE = "code"            # clean_int, 0 -> null
TEXT = "text"            # clean_text
RAW = "raw"              # passed through unchanged


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "smallint": T.ShortType(), "bigint": T.LongType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "decimal(38,0)": T.DecimalType(38, 0),
}


def spark_type(name: str) -> T.DataType:
    """Spark type of a target type name (DDL spelling)."""
    t = _TYPES.get(name.strip().lower())
    if t is None:
        t = T._parse_datatype_string(name)  # any other DDL type name
    return t


@dataclass(frozen=True)
class ColumnRule:
    name: str
    kind: str = TEXT
    target: str = "string"          # Spark SQL type of the target column
    max_length: int | None = None   # varchar(n) limit of the target column
    nullable: bool = True


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnRule, ...] = ()
    key: tuple[str, ...] = ()                 # unique key, nulls not distinct
    required: tuple[str, ...] = ()            # rows with a null here are set aside
    date_columns: tuple[str, ...] = ()        # coerced to timestamps in the period clean
    date_formats: tuple[str, ...] | None = None
    window_column: str | None = None          # date column of the extract window; None = catalogue table
    load_time_column: str | None = None       # filled with the load timestamp

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def rule(self, name: str) -> ColumnRule | None:
        for c in self.columns:
            if c.name == name:
                return c
        return None

    def target_schema(self) -> T.StructType:
        fields = [T.StructField(c.name, spark_type(c.target), c.nullable) for c in self.columns]
        if self.load_time_column:
            fields.append(T.StructField(self.load_time_column, T.TimestampType(), False))
        return T.StructType(fields)


def spec_by_name(specs: dict[str, TableSpec], name: str) -> TableSpec:
    """Case-insensitive lookup; an unknown table gets an empty rule set."""
    for k, v in specs.items():
        if k.upper() == name.upper():
            return v
    return TableSpec(name=name.upper())


# ---------------------------------------------------------------------------
# The 53-column delimited victims file and its target table.
# ---------------------------------------------------------------------------
BULK_COLUMNS = (
    "origen", "fuente", "programa", "idpersona", "idhogar",
    "tipodocumento", "documento",
    "primernombre", "segundonombre", "primerapellido", "segundoapellido", "nombrecompleto",
    "fechanacimiento", "expediciondocumento", "fechaexpediciondocumento",
    "pertenenciaetnica", "genero",
    "tipohecho", "hecho", "fechaocurrencia",
    "coddanemunicipioocurrencia", "zonaocurrencia", "ubicacionocurrencia",
    "presuntoactor", "presuntovictimizante", "fechareporte",
    "tipopoblacion", "tipovictima", "estadovictima",
    "pais", "ciudad", "coddanemunicipioresidencia",
    "zonaresidencia", "ubicacionresidencia", "direccion",
    "numtelefonofijo", "numtelefonocelular", "email",
    "fechavaloracion",
    "idsiniestro", "idmijefe", "tipodesplazamiento", "registraduria",
    "vigenciadocumento", "conspersona", "relacion",
    "coddanedeclaracion", "coddanellegada", "codigohecho",
    "discapacidad", "descripciondiscapacidad", "fud_ficha", "afectaciones",
)
BULK_DATE_COLUMNS = ("fechanacimiento", "fechaexpediciondocumento", "fechaocurrencia",
                     "fechareporte", "fechavaloracion")
BULK_INT_COLUMNS = ("idpersona", "idhogar", "coddanemunicipioocurrencia", "coddanemunicipioresidencia",
                    "idsiniestro", "idmijefe", "registraduria", "conspersona", "coddanedeclaracion",
                    "coddanellegada", "codigohecho", "discapacidad")
BULK_CODE_COLUMNS = ("coddanemunicipioocurrencia", "coddanemunicipioresidencia",
                     "coddanedeclaracion", "coddanellegada")
# target: the one date stored as text, smallint and varchar(n) columns
BULK_DATE_AS_TEXT = ("fechaexpediciondocumento",)
BULK_SMALLINT = ("discapacidad",)
BULK_VARCHAR_50 = ("origen", "fuente", "programa", "tipodocumento", "documento", "primernombre",
                   "segundonombre", "primerapellido", "segundoapellido", "genero", "tipopoblacion",
                   "tipovictima", "estadovictima", "pais", "tipodesplazamiento", "fud_ficha")
BULK_VARCHAR_100 = ("pertenenciaetnica", "ciudad")
BULK_KEY = ("idpersona", "codigohecho", "fechaocurrencia")
BULK_LOAD_TIME = "cargado_en"
BULK_SEPARATOR = "»"
BULK_ENCODING = "ISO-8859-1"
BULK_BATCH_ROWS = 10_000
# Name-based rule variant: ids that only turn blank into null.
BULK_BLANK_NULL_IDS = ("idpersona", "idhogar", "idsiniestro")
# ---------------------------------------------------------------------------


def _bulk_rule(name: str) -> ColumnRule:
    if name in BULK_DATE_AS_TEXT:
        return ColumnRule(name, DATE_TEXT, "string")
    if name in BULK_DATE_COLUMNS:
        return ColumnRule(name, DATE, "date")
    if name in BULK_CODE_COLUMNS:
        return ColumnRule(name, CODE, "int")
    if name in BULK_INT_COLUMNS:
        return ColumnRule(name, INT, "smallint" if name in BULK_SMALLINT else "int")
    if name in BULK_VARCHAR_50:
        return ColumnRule(name, TEXT, "string", 50)
    if name in BULK_VARCHAR_100:
        return ColumnRule(name, TEXT, "string", 100)
    return ColumnRule(name, TEXT, "string")


BULK_SPEC = TableSpec(
    name="personas",
    columns=tuple(_bulk_rule(c) for c in BULK_COLUMNS),
    key=BULK_KEY,
    load_time_column=BULK_LOAD_TIME,
)

# ---------------------------------------------------------------------------
# The ten period tables, their required and date columns and the
# date column of the extract window (None = catalogue table, no window).
# ---------------------------------------------------------------------------
PERIOD_RULES = {
    "PACIENTES": (("PACIENTE_ID", "NOMBRE", "FECHA_NACIMIENTO"), ("FECHA_NACIMIENTO", "CREATED_AT")),
    "CITAS_MEDICAS": (("CITA_ID", "PACIENTE_ID", "MEDICO_ID", "FECHA_CITA"), ("FECHA_CITA", "CREATED_AT")),
    "FACTURACION": (("FACTURA_ID", "PACIENTE_ID", "MONTO_TOTAL"), ("FECHA_FACTURA", "CREATED_AT")),
    "INTERNACIONES": (("INTERNACION_ID", "PACIENTE_ID", "FECHA_INGRESO"),
                      ("FECHA_INGRESO", "FECHA_EGRESO", "CREATED_AT")),
    "EXAMENES_MEDICOS": (("EXAMEN_ID", "PACIENTE_ID", "FECHA_EXAMEN"), ("FECHA_EXAMEN", "CREATED_AT")),
    "RESULTADOS_EXAMENES": (("RESULTADO_ID", "EXAMEN_ID"), ("FECHA_RESULTADO", "CREATED_AT")),
    "MEDICAMENTOS_RECETADOS": (("RECETA_ID", "PACIENTE_ID", "MEDICAMENTO_ID"), ("FECHA_RECETA", "CREATED_AT")),
    "MEDICOS": (("MEDICO_ID", "NOMBRE", "ESPECIALIDAD_ID"), ("CREATED_AT",)),
    "ESPECIALIDADES": (("ESPECIALIDAD_ID", "NOMBRE"), ()),
    "MUNICIPIOS": (("MUNICIPIO_ID", "NOMBRE"), ()),
}
PERIOD_WINDOW_COLUMN = {
    "PACIENTES": "created_at", "CITAS_MEDICAS": "created_at", "FACTURACION": "created_at",
    "INTERNACIONES": "created_at", "EXAMENES_MEDICOS": "created_at", "RESULTADOS_EXAMENES": "created_at",
    "MEDICAMENTOS_RECETADOS": "created_at", "MEDICOS": "created_at",
    "ESPECIALIDADES": None, "MUNICIPIOS": None,
}
ALL_TABLES = "TODAS"
EXTRACT_PAGE_ROWS = 10_000
DEFAULT_KEY = "ROWID"
ETL_VERSION = "tableflow 0.1.0"  # producer stamped into manifests
CRITICAL_NULL_PERCENT = 30
DUPLICATE_TAG = "fila duplicada"
REQUIRED_TAG = "{col}: valor requerido nulo"
BAD_DATE_TAG = "{col}: fecha inválida"
# names of the quality report and of its summary, before the period
QUALITY_REPORT, QUALITY_SUMMARY = "reporte_calidad", "entregable_2A"
MISMATCH_MESSAGE = "DISCREPANCIA: Oracle={source} | CSV={extracted}"
STATE_OK, STATE_ERROR = "OK", "ERROR"
# ---------------------------------------------------------------------------

PERIOD_SPECS = {
    name: TableSpec(name=name, required=req, date_columns=dates, window_column=PERIOD_WINDOW_COLUMN[name])
    for name, (req, dates) in PERIOD_RULES.items()
}


def select_tables(specs: dict[str, TableSpec], wanted: list[str] | None) -> dict[str, TableSpec]:
    """One table, several, or all (``TODAS``), matched case-insensitively."""
    if not wanted or [w.upper() for w in wanted] == [ALL_TABLES]:
        return dict(specs)
    up = {w.upper() for w in wanted}
    return {k: v for k, v in specs.items() if k.upper() in up}
