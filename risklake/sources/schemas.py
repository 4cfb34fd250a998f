"""Raw sources and their columns. Every raw column is text."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Source:
    """One raw entity: its bronze table, its file below the source folder, the columns its header must have."""

    table: str
    file: str
    columns: tuple[str, ...]
    multiline: bool = False  # quoted line breaks, which cost a second look at the lines


# File headers.
SOURCES = {
    "clientes": Source(
        "bronze_clientes",
        "clientes.csv",
        ("cliente_id", "nome", "cpf", "data_nascimento", "score_credito", "renda_mensal", "estado", "data_cadastro"),
    ),
    "emprestimos": Source(
        "bronze_emprestimos",
        "emprestimos.csv",
        ("emprestimo_id", "cliente_id", "valor_emprestado", "valor_parcela", "num_parcelas", "taxa_juros",
         "data_concessao", "status"),
    ),
    "pagamentos": Source(
        "bronze_pagamentos",
        "pagamentos.csv",
        ("pagamento_id", "emprestimo_id", "parcela_num", "data_vencimento", "data_pagamento", "valor_devido",
         "valor_pago", "status"),
    ),
    "eventos_risco": Source(
        "bronze_eventos_risco",
        "eventos_risco.csv",
        ("evento_id", "cliente_id", "emprestimo_id", "tipo_evento", "data_evento", "valor_em_risco"),
    ),
}
