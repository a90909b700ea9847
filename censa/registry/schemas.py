"""Declared column types per record group: one plain table for each.

``LOADER_COLUMNS`` has the types the bulk load of the hospital groups declares where
they differ from those of an extraction.  A site with its own type map passes it to
``load_type_map``.
"""

from __future__ import annotations

import json

# Table name of each group.
TABLE_NAMES = {
    "RD": "sih_aih_reduzida",
    "RJ": "sih_aih_rejeitada",
    "ER": "sih_aih_rejeitada_erro",
    "SP": "sih_servicos_profissionais",
    "PA": "sia_producao_ambulatorial",
    "BI": "sia_boletim_producao_ambulatorial_individualizado",
    "AB": "sia_apac_cirurgia_bariatrica",
    "ABO": "sia_apac_acompanhamento_pos_cirurgia_bariatrica",
    "ACF": "sia_apac_confeccao_de_fistula",
    "AD": "sia_apac_laudos_diversos",
    "AM": "sia_apac_medicamentos",
    "AMP": "sia_apac_acompanhamento_multiprofissional",
    "AN": "sia_apac_nefrologia",
    "AQ": "sia_apac_quimioterapia",
    "AR": "sia_apac_radioterapia",
    "ATD": "sia_apac_tratamento_dialitico",
}

# Column types of each group, in table order.
GROUP_COLUMNS: dict[str, dict[str, str]] = {
    "RD": {
        "uf_zi": "TEXT", "ano_cmpt": "INTEGER", "mes_cmpt": "SMALLINT", "n_aih": "TEXT", "ident": "TEXT",
        "nasc": "DATE", "sexo": "TEXT", "uti_mes_in": "SMALLINT", "uti_mes_an": "SMALLINT",
        "uti_mes_al": "SMALLINT", "uti_mes_to": "SMALLINT", "marca_uti": "TEXT", "uti_int_in": "SMALLINT",
        "uti_int_an": "SMALLINT", "uti_int_al": "SMALLINT", "uti_int_to": "SMALLINT", "diar_acom": "SMALLINT",
        "qt_diarias": "SMALLINT", "proc_solic": "TEXT", "proc_rea": "TEXT", "val_sh": "NUMERIC(15,2)",
        "val_sp": "NUMERIC(15,2)", "val_sadt": "NUMERIC(15,2)", "val_rn": "NUMERIC(15,2)",
        "val_acomp": "NUMERIC(15,2)", "val_ortp": "NUMERIC(15,2)", "val_sangue": "NUMERIC(15,2)",
        "val_sadtsr": "NUMERIC(15,2)", "val_transp": "NUMERIC(15,2)", "val_obsang": "NUMERIC(15,2)",
        "val_ped1ac": "NUMERIC(15,2)", "val_tot": "NUMERIC(15,2)", "val_uti": "NUMERIC(15,2)",
        "us_tot": "NUMERIC(15,2)", "dt_inter": "DATE", "dt_saida": "DATE", "diag_princ": "TEXT",
        "diag_secun": "TEXT", "ind_vdrl": "TEXT", "cod_idade": "TEXT", "idade": "SMALLINT",
        "dias_perm": "SMALLINT", "morte": "TEXT", "car_int": "TEXT", "tot_pt_sp": "NUMERIC(15,2)",
        "cnes": "TEXT", "cid_asso": "TEXT", "cid_morte": "TEXT", "complex": "TEXT", "faec_tp": "TEXT",
        "aud_just": "TEXT", "val_uci": "NUMERIC(15,2)", "diagsec1": "TEXT", "espec": "TEXT",
        "cgc_hosp": "TEXT", "cep": "TEXT", "munic_res": "INTEGER", "cobranca": "TEXT", "natureza": "TEXT",
        "nat_jur": "TEXT", "gestao": "SMALLINT", "rubrica": "TEXT", "munic_mov": "INTEGER", "nacional": "TEXT",
        "num_proc": "TEXT", "cpf_aut": "TEXT", "homonimo": "BOOLEAN", "num_filhos": "SMALLINT",
        "instru": "SMALLINT", "cid_notif": "TEXT", "contracep1": "TEXT", "contracep2": "TEXT",
        "gestrisco": "BOOLEAN", "insc_pn": "TEXT", "seq_aih5": "SMALLINT", "cbor": "TEXT", "cnaer": "TEXT",
        "vincprev": "SMALLINT", "gestor_cod": "TEXT", "gestor_tp": "SMALLINT", "gestor_cpf": "TEXT",
        "gestor_dt": "DATE", "cnpj_mant": "TEXT", "infehosp": "BOOLEAN", "financ": "TEXT", "regct": "TEXT",
        "raca_cor": "TEXT", "etnia": "TEXT", "sequencia": "BIGINT", "remessa": "TEXT", "sis_just": "TEXT",
        "val_sh_fed": "NUMERIC(12,2)", "val_sp_fed": "NUMERIC(12,2)", "val_sh_ges": "NUMERIC(12,2)",
        "val_sp_ges": "NUMERIC(12,2)", "marca_uci": "TEXT", "diagsec2": "TEXT", "diagsec3": "TEXT",
        "diagsec4": "TEXT", "diagsec5": "TEXT", "diagsec6": "TEXT", "diagsec7": "TEXT", "diagsec8": "TEXT",
        "diagsec9": "TEXT", "tpdisec1": "SMALLINT", "tpdisec2": "SMALLINT", "tpdisec3": "SMALLINT",
        "tpdisec4": "SMALLINT", "tpdisec5": "SMALLINT", "tpdisec6": "SMALLINT", "tpdisec7": "SMALLINT",
        "tpdisec8": "SMALLINT", "tpdisec9": "SMALLINT",
    },
    "RJ": {
        "cnes": "NUMERIC(7,0)", "uf_zi": "SMALLINT", "ano_cmpt": "SMALLINT", "mes_cmpt": "SMALLINT",
        "espec": "SMALLINT", "cgc_hosp": "NUMERIC(14,0)", "n_aih": "NUMERIC(13,0)", "ident": "SMALLINT",
        "cep": "NUMERIC(8,0)", "munic_res": "INTEGER", "nasc": "DATE", "sexo": "SMALLINT",
        "uti_mes_in": "SMALLINT", "uti_mes_an": "SMALLINT", "uti_mes_al": "SMALLINT", "uti_mes_to": "SMALLINT",
        "marca_uti": "SMALLINT", "uti_int_in": "SMALLINT", "uti_int_an": "SMALLINT", "uti_int_al": "SMALLINT",
        "uti_int_to": "SMALLINT", "diar_acom": "SMALLINT", "qt_diarias": "SMALLINT",
        "proc_solic": "NUMERIC(10,0)", "proc_rea": "NUMERIC(10,0)", "val_sh": "NUMERIC(10,2)",
        "val_sp": "NUMERIC(10,2)", "val_sadt": "NUMERIC(10,2)", "val_rn": "NUMERIC(10,2)",
        "val_acomp": "NUMERIC(10,2)", "val_ortp": "NUMERIC(10,2)", "val_sangue": "NUMERIC(10,2)",
        "val_tot": "NUMERIC(10,2)", "dt_inter": "DATE", "dt_saida": "DATE", "diag_princ": "TEXT",
        "diag_secun": "TEXT", "morte": "SMALLINT", "gestao": "SMALLINT", "cnpj_mant": "NUMERIC(14,0)",
        "cid_asso": "TEXT", "cid_morte": "TEXT", "complex": "SMALLINT", "financ": "NUMERIC(2,0)",
        "faec_tp": "SMALLINT", "regct": "NUMERIC(2,0)", "raca_cor": "SMALLINT", "etnia": "SMALLINT",
        "st_situac": "SMALLINT", "st_bloq": "SMALLINT", "st_mot_blo": "SMALLINT", "sequencia": "NUMERIC(6,0)",
        "remessa": "TEXT", "cod_idade": "SMALLINT", "num_filhos": "SMALLINT", "dias_perm": "SMALLINT",
        "gestor_dt": "DATE", "gestor_tp": "SMALLINT", "seq_aih5": "TEXT", "gestrisco": "SMALLINT",
        "tot_pt_sp": "SMALLINT", "us_tot": "NUMERIC(12,2)", "val_obsang": "NUMERIC(12,2)",
        "val_ped1ac": "NUMERIC(12,2)", "val_sadtsr": "NUMERIC(12,2)", "val_transp": "NUMERIC(12,2)",
        "val_uti": "NUMERIC(12,2)", "vincprev": "SMALLINT", "homonimo": "SMALLINT", "idade": "INTEGER",
        "ind_vdrl": "SMALLINT", "infehosp": "TEXT", "instru": "SMALLINT", "munic_mov": "TEXT",
        "id_log": "TEXT", "car_int": "TEXT", "cbor": "TEXT", "cid_notif": "TEXT", "cnaer": "TEXT",
        "cobranca": "SMALLINT", "contracep1": "TEXT", "contracep2": "TEXT", "cpf_aut": "TEXT",
        "gestor_cod": "TEXT", "gestor_cpf": "TEXT", "insc_pn": "TEXT", "nacional": "TEXT", "natureza": "TEXT",
        "nat_jur": "TEXT", "num_proc": "TEXT", "rubrica": "SMALLINT",
    },
    "ER": {
        "sequencia": "NUMERIC(6,0)", "remessa": "TEXT", "cnes": "NUMERIC(7,0)", "aih": "NUMERIC(13,0)",
        "ano": "NUMERIC(4,0)", "mes": "NUMERIC(2,0)", "dt_inter": "DATE", "dt_saida": "DATE",
        "mun_mov": "NUMERIC(6,0)", "uf_zi": "NUMERIC(2,0)", "mun_res": "NUMERIC(6,0)",
        "uf_res": "NUMERIC(2,0)", "co_erro": "NUMERIC(2,0)",
    },
    "SP": {
        "sp_gestor": "NUMERIC(6,0)", "sp_uf": "NUMERIC(2,0)", "sp_aa": "NUMERIC(4,0)", "sp_mm": "NUMERIC(2,0)",
        "sp_cnes": "NUMERIC(7,0)", "sp_naih": "NUMERIC(13,0)", "sp_procrea": "NUMERIC(10,0)",
        "sp_dtinter": "DATE", "sp_dtsaida": "DATE", "sp_num_pr": "TEXT", "sp_tipo": "NUMERIC(2,0)",
        "sp_cpfcgc": "NUMERIC(14,0)", "sp_atoprof": "NUMERIC(10,0)", "sp_tp_ato": "NUMERIC(2,0)",
        "sp_qtd_ato": "NUMERIC(5,0)", "sp_ptsp": "NUMERIC(2,0)", "sp_nf": "NUMERIC(12,0)",
        "sp_valato": "NUMERIC(10,2)", "sp_m_hosp": "NUMERIC(10,2)", "sp_m_pac": "NUMERIC(10,2)",
        "sp_des_hos": "NUMERIC(10,2)", "sp_des_pac": "NUMERIC(10,2)", "sp_complex": "NUMERIC(2,0)",
        "sp_financ": "NUMERIC(2,0)", "sp_co_faec": "NUMERIC(10,0)", "sp_pf_cbo": "NUMERIC(6,0)",
        "sp_pf_doc": "NUMERIC(15,0)", "sp_pj_doc": "NUMERIC(14,0)", "in_tp_val": "NUMERIC(1,0)",
        "sequencia": "NUMERIC(5,0)", "remessa": "TEXT", "serv_cla": "NUMERIC(4,0)", "sp_cidpri": "TEXT",
        "sp_cidsec": "TEXT", "sp_qt_proc": "NUMERIC(5,0)", "sp_u_aih": "NUMERIC(2,0)",
    },
    "PA": {
        "id_log": "TEXT", "idademax": "TEXT", "idademin": "TEXT", "nu_pa_tot": "TEXT",
        "nu_vpa_tot": "NUMERIC(15,2)", "pa_alta": "BOOLEAN", "pa_autoriz": "TEXT", "pa_catend": "TEXT",
        "pa_cbocod": "TEXT", "pa_cidcas": "TEXT", "pa_cidpri": "TEXT", "pa_cidsec": "TEXT",
        "pa_cmp": "INTEGER", "pa_cnpj_cc": "TEXT", "pa_cnpjcpf": "TEXT", "pa_cnpjmnt": "TEXT",
        "pa_cnsmed": "TEXT", "pa_codesp": "TEXT", "pa_codoco": "TEXT", "pa_codpro": "TEXT",
        "pa_coduni": "TEXT", "pa_condic": "TEXT", "pa_datpr": "INTEGER", "pa_datref": "INTEGER",
        "pa_dif_val": "TEXT", "pa_docorig": "TEXT", "pa_encerr": "BOOLEAN", "pa_etnia": "TEXT",
        "pa_fler": "BOOLEAN", "pa_flidade": "SMALLINT", "pa_flqt": "TEXT", "pa_fxetar": "TEXT",
        "pa_gestao": "TEXT", "pa_idade": "TEXT", "pa_incout": "TEXT", "pa_incurg": "TEXT",
        "pa_indica": "SMALLINT", "pa_ine": "TEXT", "pa_mn_ind": "TEXT", "pa_mndif": "SMALLINT",
        "pa_morfol": "TEXT", "pa_motsai": "TEXT", "pa_munat": "INTEGER", "pa_munpcn": "INTEGER",
        "pa_mvm": "DATE", "pa_nat_jur": "TEXT", "pa_nh": "TEXT", "pa_nivcpl": "SMALLINT", "pa_numapa": "TEXT",
        "pa_obito": "BOOLEAN", "pa_perman": "BOOLEAN", "pa_proc_id": "TEXT", "pa_qtdapr": "INTEGER",
        "pa_qtdpro": "INTEGER", "pa_racacor": "TEXT", "pa_rcb": "TEXT", "pa_rcbdf": "SMALLINT",
        "pa_regct": "TEXT", "pa_sexo": "TEXT", "pa_srv_c": "TEXT", "pa_subfin": "TEXT", "pa_tipate": "TEXT",
        "pa_tippre": "TEXT", "pa_tippro": "TEXT", "pa_tpfin": "TEXT", "pa_tpups": "TEXT",
        "pa_transf": "BOOLEAN", "pa_ufdif": "SMALLINT", "pa_ufmun": "TEXT", "pa_valapr": "NUMERIC(15,2)",
        "pa_valpro": "NUMERIC(15,2)", "pa_vl_cf": "NUMERIC(15,2)", "pa_vl_cl": "NUMERIC(15,2)",
        "pa_vl_inc": "NUMERIC(15,2)", "uf": "TEXT",
    },
    "BI": {
        "autoriz": "TEXT", "catend": "TEXT", "cboprof": "TEXT", "cidpri": "TEXT", "cnpj_cc": "TEXT",
        "cnpjcpf": "CHAR(14)", "cnpjmnt": "TEXT", "cns_pac": "CHAR(15)", "cnsprof": "CHAR(15)",
        "coduni": "CHAR(7)", "complex": "CHAR(1)", "condic": "CHAR(2)", "dt_atend": "CHAR(6)",
        "dt_process": "CHAR(6)", "dtnasc": "CHAR(8)", "etnia": "TEXT", "gestao": "CHAR(6)",
        "id_log": "VARCHAR(255)", "idadepac": "CHAR(2)", "mn_ind": "CHAR(1)", "mndif": "BOOLEAN",
        "munpac": "CHAR(6)", "nat_jur": "CHAR(4)", "proc_id": "TEXT", "qt_apres": "CHAR(11)",
        "qt_aprov": "CHAR(11)", "racacor": "TEXT", "sexopac": "CHAR(1)", "subfin": "TEXT", "tippre": "TEXT",
        "tpfin": "TEXT", "tpidadepac": "CHAR(1)", "tpups": "TEXT", "uf": "CHAR(2)", "ufdif": "BOOLEAN",
        "ufmun": "CHAR(6)", "vl_apres": "CHAR(20)", "vl_aprov": "CHAR(20)",
    },
    "AB": {
        "ab_anoacom": "TEXT", "ab_dtcirg2": "TEXT", "ab_dtcirur": "CHAR(8)", "ab_imc": "TEXT",
        "ab_mesacom": "TEXT", "ab_numaih": "TEXT", "ab_numaih2": "CHAR(13)", "ab_pontbar": "CHAR(1)",
        "ab_prcaih2": "CHAR(10)", "ab_prcaih3": "CHAR(10)", "ab_procaih": "CHAR(10)", "ab_tabbarr": "CHAR(1)",
        "ap_alta": "BOOLEAN", "ap_apacant": "TEXT", "ap_autoriz": "CHAR(13)", "ap_catend": "TEXT",
        "ap_ceppcn": "CHAR(8)", "ap_cidcas": "TEXT", "ap_cidpri": "TEXT", "ap_cidsec": "TEXT",
        "ap_cmp": "CHAR(6)", "ap_cnpjcpf": "CHAR(14)", "ap_cnpjmnt": "CHAR(14)", "ap_cnspcn": "CHAR(15)",
        "ap_codemi": "CHAR(10)", "ap_coduni": "TEXT", "ap_coidade": "CHAR(1)", "ap_condic": "CHAR(2)",
        "ap_dtaut": "CHAR(8)", "ap_dtfim": "CHAR(8)", "ap_dtinic": "CHAR(8)", "ap_dtocor": "TEXT",
        "ap_dtsolic": "CHAR(8)", "ap_encerr": "BOOLEAN", "ap_etnia": "CHAR(4)", "ap_gestao": "CHAR(6)",
        "ap_mn_ind": "CHAR(1)", "ap_mndif": "BOOLEAN", "ap_motsai": "CHAR(2)", "ap_munpcn": "CHAR(6)",
        "ap_mvm": "CHAR(6)", "ap_natjur": "CHAR(4)", "ap_nuidade": "CHAR(2)", "ap_obito": "BOOLEAN",
        "ap_perman": "BOOLEAN", "ap_pripal": "TEXT", "ap_racacor": "TEXT", "ap_sexo": "CHAR(1)",
        "ap_tippre": "TEXT", "ap_tpapac": "CHAR(1)", "ap_tpaten": "TEXT", "ap_tpups": "TEXT",
        "ap_transf": "BOOLEAN", "ap_ufdif": "BOOLEAN", "ap_ufmun": "CHAR(6)", "ap_ufnacio": "TEXT",
        "ap_unisol": "TEXT", "ap_vl_ap": "CHAR(20)", "id_log": "VARCHAR(255)", "uf": "CHAR(2)",
    },
    "ABO": {
        "ab_anoacom": "TEXT", "ab_dtcirg2": "CHAR(8)", "ab_dtcirur": "CHAR(8)", "ab_imc": "CHAR(3)",
        "ab_mesacom": "TEXT", "ab_numaih": "CHAR(13)", "ab_numaih2": "CHAR(13)", "ab_pontbar": "CHAR(1)",
        "ab_prcaih2": "CHAR(10)", "ab_prcaih3": "CHAR(10)", "ab_prcaih4": "CHAR(10)", "ab_prcaih5": "CHAR(10)",
        "ab_prcaih6": "CHAR(10)", "ab_procaih": "TEXT", "ab_t_prc2": "CHAR(3)", "ab_t_prc3": "CHAR(3)",
        "ab_t_prc4": "CHAR(3)", "ab_t_prc5": "CHAR(3)", "ab_t_prc6": "CHAR(3)", "ab_tabbarr": "CHAR(1)",
        "ap_adesao": "BOOLEAN", "ap_alta": "BOOLEAN", "ap_apacan": "TEXT", "ap_atv_fis": "BOOLEAN",
        "ap_autoriz": "CHAR(13)", "ap_catend": "TEXT", "ap_ceppcn": "TEXT", "ap_cid_c1": "CHAR(4)",
        "ap_cid_c2": "CHAR(4)", "ap_cid_c3": "CHAR(4)", "ap_cid_c4": "CHAR(4)", "ap_cid_c5": "CHAR(4)",
        "ap_cid_co": "CHAR(4)", "ap_cidcas": "TEXT", "ap_cmp": "CHAR(6)", "ap_cnpjcpf": "TEXT",
        "ap_cnpjmnt": "CHAR(14)", "ap_cnspcn": "CHAR(15)", "ap_codemi": "CHAR(10)", "ap_coduni": "CHAR(7)",
        "ap_coidade": "CHAR(1)", "ap_comorb": "CHAR(1)", "ap_condic": "CHAR(2)", "ap_dtaut": "CHAR(8)",
        "ap_dtfim": "CHAR(8)", "ap_dtinic": "CHAR(8)", "ap_dtoocor": "TEXT", "ap_dtsolic": "CHAR(8)",
        "ap_encerr": "BOOLEAN", "ap_etnia": "CHAR(4)", "ap_gestao": "CHAR(6)", "ap_medicam": "BOOLEAN",
        "ap_mn_ind": "CHAR(1)", "ap_mndif": "BOOLEAN", "ap_motsai": "CHAR(2)", "ap_munpcn": "CHAR(6)",
        "ap_mvm": "CHAR(6)", "ap_natjur": "CHAR(4)", "ap_nuidade": "CHAR(2)", "ap_obito": "BOOLEAN",
        "ap_perman": "BOOLEAN", "ap_polivit": "BOOLEAN", "ap_pripal": "TEXT", "ap_racacor": "TEXT",
        "ap_reg_pes": "BOOLEAN", "ap_sexo": "CHAR(1)", "ap_tpapac": "CHAR(1)", "ap_tpatend": "TEXT",
        "ap_tppre": "TEXT", "ap_tpups": "TEXT", "ap_transf": "BOOLEAN", "ap_ufdif": "BOOLEAN",
        "ap_ufmun": "CHAR(6)", "ap_ufnacio": "TEXT", "ap_unisol": "TEXT", "ap_vl_ap": "CHAR(20)",
        "co_cidprim": "TEXT", "co_cidsec": "TEXT", "id_log": "VARCHAR(255)", "uf": "CHAR(2)",
    },
    "ACF": {
        "acf_artdia": "TEXT", "acf_duplex": "CHAR(1)", "acf_flebit": "CHAR(1)", "acf_fremit": "CHAR(1)",
        "acf_hemato": "CHAR(1)", "acf_prefav": "CHAR(1)", "acf_pulso": "CHAR(1)", "acf_usocat": "CHAR(1)",
        "acf_veiavi": "CHAR(1)", "acf_veidia": "TEXT", "ap_alta": "BOOLEAN", "ap_apacant": "TEXT",
        "ap_autoriz": "CHAR(13)", "ap_catend": "TEXT", "ap_ceppcn": "TEXT", "ap_cidcas": "TEXT",
        "ap_cidpri": "TEXT", "ap_cidsec": "TEXT", "ap_cmp": "CHAR(6)", "ap_cnpjcpf": "TEXT",
        "ap_cnpjmnt": "CHAR(14)", "ap_cnspcn": "CHAR(15)", "ap_codemi": "CHAR(10)", "ap_coduni": "CHAR(7)",
        "ap_coidade": "CHAR(1)", "ap_condic": "CHAR(2)", "ap_dtaut": "CHAR(8)", "ap_dtfim": "CHAR(8)",
        "ap_dtinic": "CHAR(8)", "ap_dtocor": "CHAR(8)", "ap_dtsolic": "TEXT", "ap_encerr": "BOOLEAN",
        "ap_etnia": "CHAR(4)", "ap_gestao": "CHAR(6)", "ap_mn_ind": "CHAR(1)", "ap_mndif": "BOOLEAN",
        "ap_motsai": "CHAR(2)", "ap_munpcn": "CHAR(6)", "ap_mvm": "CHAR(6)", "ap_natjur": "CHAR(4)",
        "ap_nuidade": "CHAR(2)", "ap_obito": "BOOLEAN", "ap_perman": "BOOLEAN", "ap_pripal": "TEXT",
        "ap_racacor": "TEXT", "ap_sexo": "CHAR(1)", "ap_tippre": "TEXT", "ap_tpapac": "CHAR(1)",
        "ap_tpaten": "CHAR(2)", "ap_tpups": "TEXT", "ap_transf": "BOOLEAN", "ap_ufdif": "BOOLEAN",
        "ap_ufmun": "CHAR(6)", "ap_ufnacio": "TEXT", "ap_unisol": "CHAR(7)", "ap_vl_ap": "CHAR(20)",
        "id_log": "VARCHAR(255)", "uf": "CHAR(2)",
    },
    "AD": {
        "ap_alta": "BOOLEAN", "ap_apacant": "TEXT", "ap_autoriz": "CHAR(13)", "ap_catend": "TEXT",
        "ap_ceppcn": "TEXT", "ap_cidcas": "TEXT", "ap_cidpri": "CHAR(4)", "ap_cidsec": "TEXT",
        "ap_cmp": "CHAR(6)", "ap_cnpjcpf": "TEXT", "ap_cnpjmnt": "CHAR(14)", "ap_cnspcn": "CHAR(15)",
        "ap_codemi": "CHAR(10)", "ap_coduni": "TEXT", "ap_coidade": "CHAR(1)", "ap_condic": "CHAR(2)",
        "ap_dtaut": "CHAR(8)", "ap_dtfim": "CHAR(8)", "ap_dtinic": "CHAR(8)", "ap_dtocor": "TEXT",
        "ap_dtsolic": "CHAR(8)", "ap_encerr": "BOOLEAN", "ap_etnia": "TEXT", "ap_gestao": "CHAR(6)",
        "ap_mn_ind": "CHAR(1)", "ap_mndif": "BOOLEAN", "ap_motsai": "CHAR(2)", "ap_munpcn": "CHAR(6)",
        "ap_mvm": "CHAR(6)", "ap_natjur": "CHAR(4)", "ap_nuidade": "CHAR(2)", "ap_obito": "BOOLEAN",
        "ap_perman": "BOOLEAN", "ap_pripal": "TEXT", "ap_racacor": "TEXT", "ap_sexo": "CHAR(1)",
        "ap_tippre": "TEXT", "ap_tpapac": "CHAR(1)", "ap_tpaten": "TEXT", "ap_tpups": "TEXT",
        "ap_transf": "BOOLEAN", "ap_ufdif": "BOOLEAN", "ap_ufmun": "CHAR(6)", "ap_ufnacio": "TEXT",
        "ap_unisol": "TEXT", "ap_vl_ap": "CHAR(20)", "id_log": "VARCHAR(255)", "uf": "CHAR(2)",
    },
    "AM": {
        "am_altura": "CHAR(3)", "am_gestant": "CHAR(1)", "am_peso": "TEXT", "am_qtdtran": "TEXT",
        "am_transpl": "CHAR(1)", "ap_alta": "BOOLEAN", "ap_apacant": "TEXT", "ap_autoriz": "CHAR(13)",
        "ap_catend": "TEXT", "ap_ceppcn": "TEXT", "ap_cidcas": "TEXT", "ap_cidpri": "CHAR(4)",
        "ap_cidsec": "TEXT", "ap_cmp": "CHAR(6)", "ap_cnpjcpf": "CHAR(14)", "ap_cnpjmnt": "CHAR(14)",
        "ap_cnspcn": "CHAR(15)", "ap_codemi": "CHAR(10)", "ap_coduni": "CHAR(7)", "ap_coidade": "CHAR(1)",
        "ap_condic": "CHAR(2)", "ap_dtaut": "TEXT", "ap_dtfim": "CHAR(8)", "ap_dtinic": "CHAR(8)",
        "ap_dtocor": "TEXT", "ap_dtsolic": "TEXT", "ap_encerr": "BOOLEAN", "ap_etnia": "TEXT",
        "ap_gestao": "CHAR(6)", "ap_mn_ind": "CHAR(1)", "ap_mndif": "BOOLEAN", "ap_motsai": "CHAR(2)",
        "ap_munpcn": "CHAR(6)", "ap_mvm": "CHAR(6)", "ap_natjur": "CHAR(4)", "ap_nuidade": "CHAR(2)",
        "ap_obito": "BOOLEAN", "ap_perman": "BOOLEAN", "ap_pripal": "TEXT", "ap_racacor": "TEXT",
        "ap_sexo": "CHAR(1)", "ap_tippre": "TEXT", "ap_tpapac": "CHAR(1)", "ap_tpaten": "TEXT",
        "ap_tpups": "CHAR(2)", "ap_transf": "BOOLEAN", "ap_ufdif": "BOOLEAN", "ap_ufmun": "CHAR(6)",
        "ap_ufnacio": "TEXT", "ap_unisol": "TEXT", "ap_vl_ap": "CHAR(12)", "id_log": "VARCHAR(255)",
        "uf": "CHAR(2)",
    },
    "AMP": {
        "amp_acevas": "CHAR(1)", "amp_albumi": "TEXT", "amp_caract": "CHAR(1)", "amp_dtcli": "CHAR(8)",
        "amp_dtini": "CHAR(8)", "amp_fosfor": "CHAR(4)", "amp_hb": "CHAR(4)", "amp_hbsag": "CHAR(1)",
        "amp_hcv": "CHAR(1)", "amp_hiv": "CHAR(1)", "amp_interc": "CHAR(1)", "amp_ktvsem": "TEXT",
        "amp_maisne": "CHAR(1)", "amp_pth": "TEXT", "amp_seapto": "CHAR(1)", "amp_seperi": "CHAR(1)",
        "amp_sitini": "CHAR(1)", "amp_sittra": "CHAR(1)", "amp_tru": "TEXT", "ap_alta": "BOOLEAN",
        "ap_apacant": "TEXT", "ap_autoriz": "CHAR(13)", "ap_catend": "TEXT", "ap_ceppcn": "CHAR(8)",
        "ap_cidcas": "TEXT", "ap_cidpri": "TEXT", "ap_cidsec": "TEXT", "ap_cmp": "CHAR(6)",
        "ap_cnpjcpf": "TEXT", "ap_cnpjmnt": "CHAR(14)", "ap_cnspcn": "CHAR(15)", "ap_codemi": "CHAR(10)",
        "ap_coduni": "CHAR(7)", "ap_coidade": "CHAR(1)", "ap_condic": "CHAR(2)", "ap_dtaut": "CHAR(8)",
        "ap_dtfim": "CHAR(8)", "ap_dtinic": "CHAR(8)", "ap_dtocor": "TEXT", "ap_dtsolic": "CHAR(8)",
        "ap_encerr": "BOOLEAN", "ap_etnia": "CHAR(4)", "ap_gestao": "CHAR(6)", "ap_mn_ind": "CHAR(1)",
        "ap_mndif": "BOOLEAN", "ap_motsai": "CHAR(2)", "ap_munpcn": "CHAR(6)", "ap_mvm": "CHAR(6)",
        "ap_natjur": "CHAR(4)", "ap_nuidade": "CHAR(2)", "ap_obito": "BOOLEAN", "ap_perman": "BOOLEAN",
        "ap_pripal": "TEXT", "ap_racacor": "TEXT", "ap_sexo": "CHAR(1)", "ap_tippre": "TEXT",
        "ap_tpapac": "CHAR(1)", "ap_tpaten": "CHAR(2)", "ap_tpups": "TEXT", "ap_transf": "BOOLEAN",
        "ap_ufdif": "BOOLEAN", "ap_ufmun": "CHAR(6)", "ap_ufnacio": "TEXT", "ap_unisol": "TEXT",
        "ap_vl_ap": "CHAR(20)", "id_log": "VARCHAR(255)", "uf": "CHAR(2)",
    },
    "AN": {
        "an_acevas": "CHAR(1)", "an_albumi": "TEXT", "an_altura": "TEXT", "an_cncdo": "CHAR(1)",
        "an_diures": "TEXT", "an_dtpdr": "CHAR(8)", "an_glicos": "TEXT", "an_hb": "TEXT",
        "an_hbsag": "CHAR(1)", "an_hcv": "CHAR(1)", "an_hiv": "CHAR(1)", "an_intfis": "TEXT",
        "an_peso": "TEXT", "an_tru": "TEXT", "an_ulsoab": "CHAR(1)", "ap_alta": "BOOLEAN",
        "ap_apacant": "TEXT", "ap_autoriz": "CHAR(13)", "ap_catend": "TEXT", "ap_ceppcn": "TEXT",
        "ap_cidcas": "TEXT", "ap_cidpri": "CHAR(4)", "ap_cidsec": "TEXT", "ap_cmp": "CHAR(6)",
        "ap_cnpjcpf": "CHAR(14)", "ap_cnpjmnt": "TEXT", "ap_cnspcn": "CHAR(15)", "ap_codemi": "CHAR(10)",
        "ap_coduni": "CHAR(7)", "ap_coidade": "CHAR(1)", "ap_condic": "CHAR(2)", "ap_dtaut": "CHAR(8)",
        "ap_dtfim": "CHAR(8)", "ap_dtinic": "CHAR(8)", "ap_dtocor": "TEXT", "ap_dtsolic": "CHAR(8)",
        "ap_encerr": "BOOLEAN", "ap_etnia": "CHAR(4)", "ap_gestao": "CHAR(6)", "ap_mn_ind": "CHAR(1)",
        "ap_mndif": "BOOLEAN", "ap_motsai": "CHAR(2)", "ap_munpcn": "CHAR(6)", "ap_mvm": "CHAR(6)",
        "ap_nuidade": "TEXT", "ap_obito": "BOOLEAN", "ap_perman": "BOOLEAN", "ap_pripal": "TEXT",
        "ap_racacor": "TEXT", "ap_sexo": "CHAR(1)", "ap_tippre": "CHAR(2)", "ap_tpapac": "CHAR(1)",
        "ap_tpaten": "TEXT", "ap_tpups": "TEXT", "ap_transf": "BOOLEAN", "ap_ufdif": "BOOLEAN",
        "ap_ufmun": "CHAR(6)", "ap_ufnacio": "TEXT", "ap_unisol": "CHAR(7)", "ap_vl_ap": "CHAR(20)",
        "id_log": "VARCHAR(255)", "uf": "CHAR(2)",
    },
    "AQ": {
        "ap_alta": "BOOLEAN", "ap_apacant": "TEXT", "ap_autoriz": "CHAR(13)", "ap_catend": "TEXT",
        "ap_ceppcn": "TEXT", "ap_cidcas": "TEXT", "ap_cidpri": "CHAR(4)", "ap_cidsec": "TEXT",
        "ap_cmp": "CHAR(6)", "ap_cnpjcpf": "CHAR(14)", "ap_cnpjmnt": "CHAR(14)", "ap_cnspcn": "CHAR(15)",
        "ap_codemi": "CHAR(10)", "ap_coduni": "TEXT", "ap_coidade": "CHAR(1)", "ap_condic": "CHAR(2)",
        "ap_dtaut": "CHAR(8)", "ap_dtfim": "CHAR(8)", "ap_dtinic": "CHAR(8)", "ap_dtocor": "TEXT",
        "ap_dtsolic": "CHAR(8)", "ap_encerr": "BOOLEAN", "ap_etnia": "TEXT", "ap_gestao": "CHAR(6)",
        "ap_mn_ind": "CHAR(1)", "ap_mndif": "BOOLEAN", "ap_motsai": "CHAR(2)", "ap_munpcn": "CHAR(6)",
        "ap_mvm": "CHAR(6)", "ap_natjur": "CHAR(4)", "ap_nuidade": "CHAR(2)", "ap_obito": "BOOLEAN",
        "ap_perman": "BOOLEAN", "ap_pripal": "TEXT", "ap_racacor": "TEXT", "ap_sexo": "CHAR(1)",
        "ap_tippre": "TEXT", "ap_tpapac": "CHAR(1)", "ap_tpaten": "TEXT", "ap_tpups": "TEXT",
        "ap_transf": "BOOLEAN", "ap_ufdif": "BOOLEAN", "ap_ufmun": "CHAR(6)", "ap_ufnacio": "TEXT",
        "ap_unisol": "TEXT", "ap_vl_ap": "CHAR(12)", "aq_cid10": "CHAR(4)", "aq_cidini1": "CHAR(4)",
        "aq_cidini2": "CHAR(4)", "aq_cidini3": "CHAR(4)", "aq_conttr": "CHAR(1)", "aq_dtiden": "CHAR(8)",
        "aq_dtini1": "TEXT", "aq_dtini2": "TEXT", "aq_dtini3": "TEXT", "aq_dtintr": "CHAR(8)",
        "aq_esqu_p1": "CHAR(5)", "aq_esqu_p2": "CHAR(10)", "aq_estadi": "TEXT", "aq_grahis": "TEXT",
        "aq_linfin": "TEXT", "aq_med01": "TEXT", "aq_med02": "TEXT", "aq_med03": "TEXT", "aq_med04": "TEXT",
        "aq_med05": "TEXT", "aq_med06": "TEXT", "aq_med07": "TEXT", "aq_med08": "TEXT", "aq_med09": "TEXT",
        "aq_med10": "TEXT", "aq_totmau": "TEXT", "aq_totmpl": "TEXT", "aq_trante": "TEXT",
        "id_log": "VARCHAR(255)", "uf": "CHAR(2)",
    },
    "AR": {
        "ap_alta": "BOOLEAN", "ap_apacant": "TEXT", "ap_autoriz": "CHAR(13)", "ap_catend": "TEXT",
        "ap_ceppcn": "TEXT", "ap_cidcas": "TEXT", "ap_cidpri": "CHAR(4)", "ap_cidsec": "TEXT",
        "ap_cmp": "CHAR(6)", "ap_cnpjcpf": "CHAR(14)", "ap_cnpjmnt": "CHAR(14)", "ap_cnspcn": "CHAR(15)",
        "ap_codemi": "CHAR(10)", "ap_coduni": "CHAR(7)", "ap_coidade": "CHAR(1)", "ap_condic": "CHAR(2)",
        "ap_dtaut": "CHAR(8)", "ap_dtfim": "CHAR(8)", "ap_dtinic": "CHAR(8)", "ap_dtocor": "CHAR(8)",
        "ap_dtsolic": "CHAR(8)", "ap_encerr": "BOOLEAN", "ap_etnia": "CHAR(4)", "ap_gestao": "CHAR(6)",
        "ap_mn_ind": "CHAR(1)", "ap_mndif": "BOOLEAN", "ap_motsai": "CHAR(2)", "ap_munpcn": "CHAR(6)",
        "ap_mvm": "CHAR(6)", "ap_natjur": "CHAR(4)", "ap_nuidade": "CHAR(2)", "ap_obito": "BOOLEAN",
        "ap_perman": "BOOLEAN", "ap_pripal": "TEXT", "ap_racacor": "TEXT", "ap_sexo": "CHAR(1)",
        "ap_tippre": "TEXT", "ap_tpapac": "CHAR(1)", "ap_tpaten": "TEXT", "ap_tpups": "TEXT",
        "ap_transf": "BOOLEAN", "ap_ufdif": "BOOLEAN", "ap_ufmun": "CHAR(6)", "ap_ufnacio": "TEXT",
        "ap_unisol": "TEXT", "ap_vl_ap": "CHAR(20)", "ar_cid10": "CHAR(4)", "ar_cidini1": "CHAR(4)",
        "ar_cidini2": "CHAR(4)", "ar_cidini3": "CHAR(4)", "ar_cidtr1": "CHAR(4)", "ar_cidtr2": "CHAR(4)",
        "ar_cidtr3": "CHAR(4)", "ar_conttr": "CHAR(1)", "ar_dtiden": "CHAR(8)", "ar_dtini1": "TEXT",
        "ar_dtini2": "TEXT", "ar_dtini3": "TEXT", "ar_dtintr": "CHAR(8)", "ar_estadi": "TEXT",
        "ar_fimar1": "CHAR(8)", "ar_fimar2": "CHAR(8)", "ar_fimar3": "CHAR(8)", "ar_finali": "CHAR(1)",
        "ar_grahis": "TEXT", "ar_iniar1": "CHAR(8)", "ar_iniar2": "CHAR(8)", "ar_iniar3": "CHAR(8)",
        "ar_linfin": "TEXT", "ar_numc1": "CHAR(3)", "ar_numc2": "CHAR(3)", "ar_numc3": "CHAR(3)",
        "ar_smrd": "CHAR(3)", "ar_trante": "CHAR(1)", "id_log": "VARCHAR(255)", "uf": "CHAR(2)",
    },
    "ATD": {
        "ap_alta": "BOOLEAN", "ap_apacant": "TEXT", "ap_autoriz": "CHAR(13)", "ap_catend": "TEXT",
        "ap_ceppcn": "TEXT", "ap_cidcas": "TEXT", "ap_cidpri": "TEXT", "ap_cidsec": "TEXT",
        "ap_cmp": "CHAR(6)", "ap_cnpjcpf": "TEXT", "ap_cnpjmnt": "CHAR(14)", "ap_cnspcn": "CHAR(15)",
        "ap_codemi": "CHAR(10)", "ap_coduni": "CHAR(7)", "ap_coidade": "CHAR(1)", "ap_condic": "CHAR(2)",
        "ap_dtaut": "TEXT", "ap_dtfim": "CHAR(8)", "ap_dtinic": "CHAR(8)", "ap_dtocor": "TEXT",
        "ap_dtsolic": "TEXT", "ap_encerr": "BOOLEAN", "ap_etnia": "TEXT", "ap_gestao": "CHAR(6)",
        "ap_mn_ind": "CHAR(1)", "ap_mndif": "BOOLEAN", "ap_motsai": "CHAR(2)", "ap_munpcn": "CHAR(6)",
        "ap_mvm": "CHAR(6)", "ap_natjur": "CHAR(4)", "ap_nuidade": "TEXT", "ap_obito": "BOOLEAN",
        "ap_perman": "BOOLEAN", "ap_pripal": "TEXT", "ap_racacor": "TEXT", "ap_sexo": "CHAR(1)",
        "ap_tippre": "TEXT", "ap_tpapac": "CHAR(1)", "ap_tpaten": "CHAR(2)", "ap_tpups": "TEXT",
        "ap_transf": "BOOLEAN", "ap_ufdif": "BOOLEAN", "ap_ufmun": "CHAR(6)", "ap_ufnacio": "TEXT",
        "ap_unisol": "TEXT", "ap_vl_ap": "CHAR(20)", "atd_acevas": "CHAR(1)", "atd_albumi": "TEXT",
        "atd_caract": "CHAR(1)", "atd_dtcli": "CHAR(8)", "atd_dtpdr": "CHAR(8)", "atd_fosfor": "TEXT",
        "atd_hb": "TEXT", "atd_hbsag": "CHAR(1)", "atd_hcv": "CHAR(1)", "atd_hiv": "CHAR(1)",
        "atd_interc": "CHAR(1)", "atd_ktvsem": "TEXT", "atd_maisne": "CHAR(1)", "atd_pth": "TEXT",
        "atd_seapto": "TEXT", "atd_seperi": "CHAR(1)", "atd_sitini": "CHAR(1)", "atd_sittra": "CHAR(1)",
        "atd_tru": "TEXT", "id_log": "VARCHAR(255)", "uf": "CHAR(2)",
    },
}

# Column types the bulk load declares, in table order.
LOADER_COLUMNS: dict[str, dict[str, str]] = {
    "RD": {
        "uf_zi": "INTEGER", "ano_cmpt": "SMALLINT", "mes_cmpt": "SMALLINT", "espec": "CHAR(2)",
        "cgc_hosp": "CHAR(14)", "n_aih": "BIGINT", "ident": "SMALLINT", "cep": "CHAR(8)",
        "munic_res": "INTEGER", "nasc": "DATE", "sexo": "CHAR(1)", "uti_mes_in": "SMALLINT",
        "uti_mes_an": "SMALLINT", "uti_mes_al": "SMALLINT", "uti_mes_to": "SMALLINT", "marca_uti": "CHAR(2)",
        "uti_int_in": "SMALLINT", "uti_int_an": "SMALLINT", "uti_int_al": "SMALLINT", "uti_int_to": "SMALLINT",
        "diar_acom": "SMALLINT", "qt_diarias": "SMALLINT", "proc_solic": "VARCHAR(20)",
        "proc_rea": "VARCHAR(20)", "val_sh": "NUMERIC(12,2)", "val_sp": "NUMERIC(10,2)",
        "val_sadt": "NUMERIC(10,2)", "val_rn": "NUMERIC(10,2)", "val_acomp": "NUMERIC(10,2)",
        "val_ortp": "NUMERIC(10,2)", "val_sangue": "NUMERIC(10,2)", "val_sadtsr": "NUMERIC(10,2)",
        "val_transp": "NUMERIC(10,2)", "val_obsang": "NUMERIC(10,2)", "val_ped1ac": "NUMERIC(10,2)",
        "val_tot": "NUMERIC(14,2)", "val_uti": "NUMERIC(15,2)", "us_tot": "NUMERIC(10,2)", "dt_inter": "DATE",
        "dt_saida": "DATE", "diag_princ": "VARCHAR(10)", "diag_secun": "VARCHAR(4)", "cobranca": "VARCHAR(2)",
        "natureza": "CHAR(2)", "nat_jur": "VARCHAR(4)", "gestao": "SMALLINT", "rubrica": "CHAR(4)",
        "ind_vdrl": "BOOLEAN", "munic_mov": "INTEGER", "cod_idade": "SMALLINT", "idade": "SMALLINT",
        "dias_perm": "SMALLINT", "morte": "BOOLEAN", "nacional": "VARCHAR(3)", "num_proc": "VARCHAR(4)",
        "car_int": "CHAR(2)", "tot_pt_sp": "NUMERIC(10,2)", "cpf_aut": "CHAR(11)", "homonimo": "BOOLEAN",
        "num_filhos": "SMALLINT", "instru": "SMALLINT", "cid_notif": "VARCHAR(4)", "contracep1": "CHAR(2)",
        "contracep2": "CHAR(2)", "gestrisco": "BOOLEAN", "insc_pn": "CHAR(12)", "seq_aih5": "SMALLINT",
        "cbor": "CHAR(6)", "cnaer": "CHAR(3)", "vincprev": "SMALLINT", "gestor_cod": "CHAR(5)",
        "gestor_tp": "SMALLINT", "gestor_cpf": "CHAR(15)", "gestor_dt": "DATE", "cnes": "INTEGER",
        "cnpj_mant": "CHAR(14)", "infehosp": "BOOLEAN", "cid_asso": "VARCHAR(4)", "cid_morte": "VARCHAR(4)",
        "complex": "CHAR(2)", "financ": "CHAR(2)", "faec_tp": "CHAR(6)", "regct": "CHAR(4)",
        "raca_cor": "CHAR(2)", "etnia": "CHAR(4)", "sequencia": "BIGINT", "remessa": "VARCHAR(50)",
        "aud_just": "TEXT", "sis_just": "TEXT", "val_sh_fed": "NUMERIC(12,2)", "val_sp_fed": "NUMERIC(12,2)",
        "val_sh_ges": "NUMERIC(12,2)", "val_sp_ges": "NUMERIC(12,2)", "val_uci": "NUMERIC(15,2)",
        "marca_uci": "CHAR(2)", "diagsec1": "VARCHAR(4)", "diagsec2": "VARCHAR(4)", "diagsec3": "VARCHAR(4)",
        "diagsec4": "VARCHAR(4)", "diagsec5": "VARCHAR(4)", "diagsec6": "VARCHAR(4)", "diagsec7": "VARCHAR(4)",
        "diagsec8": "VARCHAR(4)", "diagsec9": "VARCHAR(4)", "tpdisec1": "SMALLINT", "tpdisec2": "SMALLINT",
        "tpdisec3": "SMALLINT", "tpdisec4": "SMALLINT", "tpdisec5": "SMALLINT", "tpdisec6": "SMALLINT",
        "tpdisec7": "SMALLINT", "tpdisec8": "SMALLINT", "tpdisec9": "SMALLINT",
    },
    "RJ": {
        "cnes": "VARCHAR(7)", "cod_idade": "SMALLINT", "num_filhos": "SMALLINT", "diar_acom": "SMALLINT",
        "n_aih": "BIGINT", "gestao": "SMALLINT", "dias_perm": "SMALLINT", "qt_diarias": "SMALLINT",
        "dt_inter": "DATE", "gestor_dt": "DATE", "gestor_tp": "SMALLINT", "seq_aih5": "VARCHAR(3)",
        "gestrisco": "SMALLINT", "tot_pt_sp": "SMALLINT", "uf_zi": "VARCHAR(6)", "us_tot": "NUMERIC(12,2)",
        "uti_int_al": "SMALLINT", "uti_int_an": "SMALLINT", "uti_int_in": "SMALLINT", "uti_int_to": "SMALLINT",
        "uti_mes_al": "SMALLINT", "uti_mes_an": "SMALLINT", "uti_mes_in": "SMALLINT", "uti_mes_to": "SMALLINT",
        "val_acomp": "NUMERIC(12,2)", "val_obsang": "NUMERIC(12,2)", "val_ortp": "NUMERIC(12,2)",
        "val_ped1ac": "NUMERIC(12,2)", "val_rn": "NUMERIC(12,2)", "val_sadt": "NUMERIC(12,2)",
        "val_sadtsr": "NUMERIC(12,2)", "val_sangue": "NUMERIC(12,2)", "val_sh": "NUMERIC(12,2)",
        "val_sp": "NUMERIC(12,2)", "val_tot": "NUMERIC(15,2)", "val_transp": "NUMERIC(12,2)",
        "val_uti": "NUMERIC(12,2)", "vincprev": "SMALLINT", "homonimo": "SMALLINT", "idade": "INTEGER",
        "ident": "SMALLINT", "ind_vdrl": "SMALLINT", "infehosp": "VARCHAR(1)", "dt_saida": "DATE",
        "instru": "SMALLINT", "sequencia": "INTEGER", "mes_cmpt": "SMALLINT", "morte": "SMALLINT",
        "munic_mov": "VARCHAR(6)", "munic_res": "VARCHAR(6)", "ano_cmpt": "INTEGER", "nasc": "DATE",
        "marca_uti": "SMALLINT", "remessa": "VARCHAR(20)", "id_log": "VARCHAR(255)", "st_situac": "SMALLINT",
        "st_bloq": "SMALLINT", "st_mot_blo": "VARCHAR(2)", "car_int": "VARCHAR(2)", "cbor": "VARCHAR(6)",
        "cep": "VARCHAR(8)", "cgc_hosp": "VARCHAR(14)", "cid_asso": "VARCHAR(4)", "cid_morte": "VARCHAR(4)",
        "cid_notif": "VARCHAR(4)", "cnaer": "VARCHAR(3)", "cnpj_mant": "VARCHAR(14)", "cobranca": "SMALLINT",
        "complex": "VARCHAR(2)", "contracep1": "VARCHAR(2)", "contracep2": "VARCHAR(2)",
        "cpf_aut": "VARCHAR(11)", "diag_princ": "VARCHAR(4)", "diag_secun": "VARCHAR(4)", "espec": "SMALLINT",
        "etnia": "VARCHAR(4)", "faec_tp": "VARCHAR(6)", "financ": "VARCHAR(2)", "gestor_cod": "VARCHAR(5)",
        "gestor_cpf": "VARCHAR(15)", "insc_pn": "VARCHAR(12)", "nacional": "VARCHAR(3)",
        "natureza": "VARCHAR(2)", "nat_jur": "VARCHAR(4)", "num_proc": "VARCHAR(4)", "proc_rea": "VARCHAR(10)",
        "proc_solic": "VARCHAR(10)", "raca_cor": "VARCHAR(2)", "regct": "VARCHAR(4)", "rubrica": "SMALLINT",
        "sexo": "SMALLINT",
    },
    "ER": {
        "sequencia": "INTEGER", "remessa": "VARCHAR(50)", "cnes": "INTEGER", "aih": "BIGINT",
        "ano": "SMALLINT", "mes": "SMALLINT", "dt_inter": "DATE", "dt_saida": "DATE", "mun_mov": "INTEGER",
        "uf_zi": "INTEGER", "mun_res": "INTEGER", "uf_res": "CHAR(2)", "co_erro": "VARCHAR(10)",
    },
}


def default_groups() -> dict[str, dict]:
    """``{group: {"table": name, "columns": {column: sql type}}}`` for all groups."""
    return {group: {"table": TABLE_NAMES[group], "columns": dict(columns)} for group, columns in GROUP_COLUMNS.items()}


def loader_types(group: str) -> dict[str, str]:
    """Column types the bulk load of a group declares."""
    return dict(LOADER_COLUMNS.get(group) or GROUP_COLUMNS[group])


def load_type_map(path: str) -> dict[str, dict[str, str]]:
    """Read a ``{table: {column: sql type}}`` JSON document written by a site."""
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)
