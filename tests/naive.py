"""The views over plain joins, as SQL on Spark: what the folded plans have to equal."""

from pyspark.sql import DataFrame, SparkSession

MONEY = "cast(valor_emprestado as decimal(18,2))"


def por_estado(spark: SparkSession) -> DataFrame:
    return spark.sql(f"""
        select estado, count(distinct emprestimo_id) as total_emprestimos,
               count(distinct emprestimo_id) filter (where status = 'INADIMPLENTE') as inadimplentes,
               round(count(distinct emprestimo_id) filter (where status = 'INADIMPLENTE') * 100.0D
                     / count(distinct emprestimo_id), 2) as taxa_inadimplencia_pct,
               round(cast(sum(if(status = 'INADIMPLENTE', {MONEY}, 0)) as double), 2) as valor_em_risco
        from l join c using (cliente_id) group by estado""")


def ranking(spark: SparkSession) -> DataFrame:
    return spark.sql(f"""
        with x as (
          select c.cliente_id, nome, score_credito, faixa_risco, estado, count(l.emprestimo_id) as total_emprestimos,
                 sum({MONEY}) as total, sum(if(status = 'INADIMPLENTE', {MONEY}, 0)) as bad,
                 count(evento_id) as total_eventos_risco, max(severidade) as maior_severidade
          from c left join l on c.cliente_id = l.cliente_id left join v on c.cliente_id = v.cliente_id
          group by 1, 2, 3, 4, 5)
        select cliente_id, nome, score_credito, faixa_risco, estado, total_emprestimos,
               cast(total as double) as valor_total_emprestado, cast(bad as double) as valor_inadimplente,
               total_eventos_risco, maior_severidade, cast(rank() over (order by bad desc) as long)
               as ranking_exposicao,
               round(cast(bad as double) * 100.0D / nullif(cast(total as double), 0D), 2) as pct_inadimplente
        from x where bad > 0""")


def por_score(spark: SparkSession) -> DataFrame:
    return spark.sql(f"""
        select faixa_risco, round(avg(score_credito), 0) as score_medio,
               count(distinct cliente_id) as total_clientes, count(distinct emprestimo_id) as total_emprestimos,
               count(distinct emprestimo_id) filter (where status = 'INADIMPLENTE') as inadimplentes,
               round(avg(taxa_juros), 2) as taxa_juros_media,
               round(cast(sum({MONEY}) as double) / count(valor_emprestado), 2) as ticket_medio,
               round(count(distinct emprestimo_id) filter (where status = 'INADIMPLENTE') * 100.0D
                     / nullif(count(distinct emprestimo_id), 0), 2) as taxa_inadimplencia_pct
        from c join l using (cliente_id) group by faixa_risco""")


def alerta(spark: SparkSession) -> DataFrame:
    return spark.sql(f"""
        with h as (
          select cliente_id, count_if(dias_atraso > 0) as qtd, max(dias_atraso) as maior,
                 avg(dias_atraso) filter (where dias_atraso > 0) as media
          from l join p using (emprestimo_id) group by cliente_id)
        select c.cliente_id, nome, score_credito, faixa_risco, estado, qtd as qtd_atrasos, maior as maior_atraso,
               round(media, 1) as media_atraso, cast(sum({MONEY}) as double) as exposicao_total,
               round(qtd * 10 + case when maior > 60 then 30 when maior > 30 then 15 else 5 end
                     + (850 - score_credito) / 20.0D, 1) as score_risco_composto
        from c join l on c.cliente_id = l.cliente_id join h on h.cliente_id = c.cliente_id
        where status = 'ATIVO' and qtd > 0
        group by c.cliente_id, nome, score_credito, faixa_risco, estado, qtd, maior, media""")
