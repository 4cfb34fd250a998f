"""A small dirty loan book as raw files. Spaces around some words are part of the data."""

CLIENTES = """cliente_id;nome;cpf;data_nascimento;score_credito;renda_mensal;estado;data_cadastro
1; Ana Souza ;123.456.789-01;1990-05-10;780;12000.50; sp ;2021-03-01
2;Bruno Lima;222.333.444-55;1985-01-20;600;5000;RJ;2022-07-15
3;Caio;333.444.555-66;bad;498;;MG;2022-01-01
4;Duda;444.555.666-77;2000-02-29;500;1999,99;sp;2023-01-01
5;Eva;;1999-01-01;700;3000;SP;2023-01-01
6;Fabio;555.666.777-88;1970-12-12;NA;3000;PR;2023-01-01
;Gil;666.777.888-99;1970-12-12;700;3000;PR;2023-01-01
8;Hugo;888.999.000-11;1995-06-06;abc;2500;BA;2023-05-05
"""

EMPRESTIMOS = (
    """emprestimo_id;cliente_id;valor_emprestado;valor_parcela;num_parcelas;taxa_juros;data_concessao;status
10;1;10000;900;12;1.2;2024-01-15;ATIVO
11;1;5000;500;12;1.5;2024-01-20;INADIMPLENTE
12;2;8000;800;12;2.5;2024-02-10;INADIMPLENTE
13;2;2000;200;12;3;2024-03-05;QUITADO
14;3;1000;200;6;7;2024-03-09;ATIVO
15;4;3000;300;12;5;2024-03-11; inadimplente"""
    + " "
    + """
16;4;4000;400;12;5.5;2024-05-02;INADIMPLENTE
17;99;700;70;12;6;2024-05-03;ATIVO
18;;700;70;12;6;2024-05-03;ATIVO
"""
)

PAGAMENTOS = """pagamento_id;emprestimo_id;parcela_num;data_vencimento;data_pagamento;valor_devido;valor_pago;status
100;10;1;2024-02-14;2024-02-12;900;900;pago
101;10;2;2024-03-15;2024-04-29;900;918;ATRASADO
102;14;1;2024-04-08;;200;;PENDENTE
103;14;2;2024-05-08;2024-07-17;200;204;ATRASADO
104;17;1;2024-06-02;2024-06-12;70;71.4;ATRASADO
105;11;1;2024-02-19;2024-02-24;500;510;ATRASADO
;11;2;2024-03-20;2024-03-25;500;510;ATRASADO
"""

EVENTOS = """evento_id;cliente_id;emprestimo_id;tipo_evento;data_evento;valor_em_risco
1000;1;11;ATRASO_30;2024-02-19;5000
1001;1;11;CALOTE;2024-05-19;2000
1002;2;12; atraso_60 ;2024-04-10;6400
1003;99;17;ATRASO_90;2024-08-01;420
;1;11;ATRASO_60;2024-03-20;4000
"""

FILES = {
    "clientes.csv": CLIENTES,
    "emprestimos.csv": EMPRESTIMOS,
    "pagamentos.csv": PAGAMENTOS,
    "eventos_risco.csv": EVENTOS,
}


def write_files(folder) -> str:
    for name, content in FILES.items():
        (folder / name).write_text(content, encoding="utf-8")
    return str(folder)
