"""The small entity most tests use."""

from stratagate import vocabulary as v
from stratagate.contract import DEFAULT_ACTIONS, Contract, Dialect, Field, Labels, Rule
from stratagate.functions.text import empty_to_null, trim_ends

ITEMS = Contract(
    "org",
    "base",
    "itens",
    fields=(
        Field("codigo", header="CODIGO", nullable=False),
        Field("valor", v.DECIMAL, header="VALOR", precision=10, scale=2, decimal_mark=","),
        Field("data", v.DATE, header="DATA", date_format="AAAAMMDD"),
        Field(
            "situacao",
            header="SITUACAO",
            domain=Labels({"A": "Ativo", "I": "Inativo"}, "situacao_descricao"),
        ),
    ),
    key=("codigo",),
    rules=(
        Rule("valor_positivo", "valor IS NULL OR valor > 0", ("valor",), v.ALERT, "Accuracy"),
    ),
    actions={**DEFAULT_ACTIONS, v.DOMAIN: v.QUARANTINE_AND_ALERT},
    default_transforms=(trim_ends, empty_to_null),
    dialect=Dialect(tolerance=0.5),
    file_pattern="*.csv",
    part_count=1,
    read_hash="read-1",
    full_hash="full-1",
)

HEADER = "CODIGO;VALOR;DATA;SITUACAO\n"
GOOD = HEADER + "1;2,50;20260901;A\n2;3,00;20260902;I\n"
DIRTY = (
    HEADER
    + "1;2,50;20260901;A\n2;3,00;20260902;I\n3;x;20260902;I\n3;1,00;20260902;I\n"
    + "4;1,00;20261302;I\n;1,00;20261202;A\n5;-1,00;20261202;A\n6;1,00;20261202;Z\n"
    + "7;1;2\n7;1;2\n7;1;2;3;4\n"
)


def write(folder, name: str, data: str | bytes) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_bytes(data.encode() if isinstance(data, str) else data)
    return str(path)
