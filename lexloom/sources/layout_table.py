"""The layouts of the registered sources, and a small document of each.

A sample is a document as its source publishes it, with marks for what varies: the id, the title, two
texts, a later text of the first, and the days on which they are published and changed.  ``rows`` are
the units that it holds: unit, kind, heading, src, day, text.
"""

from __future__ import annotations

from dataclasses import dataclass

from lexloom.sources.layouts import Layout

# The element names, classes, members and codes below are those of the sources' formats.

LAYOUTS: dict[str, Layout] = {}


def _add(code: str, form: str, rules, **paths) -> None:
    LAYOUTS[code] = Layout(code, form, tuple(rules), **paths)


_AKN_RULES = (("preface", "skip"), ("meta", "skip"), ("part", "head+:part"), ("title", "head+:title"), ("chapter", "head+:chapter"), ("article", "unit:article"), ("section", "unit:article"))
_AKN = {"uid": "@eid | @id", "heading": "num + heading", "paras": "p"}

_add("es", "xml", [("bloque", "unit:@tipo")], uid="@id", heading="@titulo", nested="version", paras="p", src="@id_norma | metadatos/identificador",
     pub="@fecha_publicacion | metadatos/fecha_publicacion", eff="@fecha_vigencia", expiry="@fecha_caducidad",
     title="metadatos/titulo", department="metadatos/departamento", rank="metadatos/rango@codigo | metadatos/rango", rank_else="otro",
     ranks={"1070": "constitucion", "1290": "ley_organica", "1300": "ley", "1310": "real_decreto_legislativo", "1320": "real_decreto_ley", "1340": "real_decreto", "1350": "orden", "1370": "resolucion", "1180": "acuerdo_internacional", "1390": "circular", "1410": "instruccion", "1510": "decreto", "1020": "acuerdo", "1450": "ley_foral", "1520": "decreto_foral", "1470": "decreto_legislativo", "1500": "decreto_ley", "1325": "decreto_ley_foral", "1480": "decreto_foral_legislativo", "1220": "reglamento", "1676": "reforma", "1590": "correccion", "1240": "sentencia", "1250": "auto", "63": "providencia", "41": "nota_diplomatica"},
     states=(("estatus_derogacion~^[TS]$", "repealed"), ("estatus_derogacion~^P$", "partially_repealed"), ("estatus_anulacion~^S$", "annulled"), ("judicialmente_anulada~^S$", "annulled"), ("vigencia_agotada~^S$", "expired")))

_add("fr", "xml", [("section", "head:section"), ("article", "unit:article")], body="elements", uid="@cid | @id", heading="@num | @titre", paras="contenu/p | contenu", group="rows",
     src="source_modif@id | @id", pub="@debut | meta/date_publi", eff="@debut", dead="@etat = ABROGE,ABROGE_DIFF", ends="@fin",
     title="meta/titrefull | meta/titre", department="meta/autorite", rank="meta/nature", rank_else="otro",
     ranks={"CODE": "code", "CONSTITUTION": "constitution_fr", "LOI": "loi", "LOI ORGANIQUE": "loi_organique", "LOI_ORGANIQUE": "loi_organique", "ORDONNANCE": "ordonnance", "DECRET": "decret", "DÉCRET": "decret"},
     states=(("meta/etat~^ABROGE", "repealed"), ("meta/etat~^MODIFIE$", "partially_repealed")))

_add("uk", "json", [("part", "head+:part"), ("chapter", "head+:chapter"), ("schedule", "head+:schedule"), ("p1", "unit:section")], envelope="versions", inner="xml xml_b64", packed=True, body="body | schedules | .",
     uid="@id", heading="number + title | pnumber", paras="text", eff="effective_date", pub="effective_date",
     title="title", rank="type", rank_else="unknown",
     ranks={"UnitedKingdomPublicGeneralAct": "public-general-act", "UnitedKingdomLocalAct": "local-act", "UnitedKingdomChurchMeasure": "church-measure", "UnitedKingdomChurchInstrument": "church-instrument", "ScottishAct": "act-of-scottish-parliament", "ScottishOldAct": "act-of-scottish-parliament-old", "WelshNationalAssemblyAct": "act-of-senedd-cymru", "WelshParliamentAct": "act-of-senedd-cymru", "WelshNationalAssemblyMeasure": "measure-of-senedd-cymru", "NorthernIrelandAct": "act-of-northern-ireland-assembly", "NorthernIrelandOldAct": "act-of-northern-ireland-assembly-old", "UnitedKingdomStatutoryInstrument": "statutory-instrument", "ScottishStatutoryInstrument": "scottish-statutory-instrument", "WelshStatutoryInstrument": "welsh-statutory-instrument", "NorthernIrelandStatutoryRule": "ni-statutory-rule", "NorthernIrelandStatutoryRuleOrOrder": "ni-statutory-rule-or-order"},
     states=(("[status=Revoked]", "repealed"), ("[status=Repealed]", "repealed")))

_add("nl", "xml", [("meta-data", "skip"), ("redactie", "skip"), ("hoofdstuk", "head+:chapter"), ("titeldeel", "head+:title"), ("afdeling", "head+:division"), ("paragraaf", "head+:section"), ("artikel", "unit:article"), ("bijlage", "unit:annex")], envelope="expression", body="wettekst | regeling",
     uid="@label-id | @id", heading="kop/label + kop/nr + kop/titel", paras="al", src="@bron", pub="@effective-date", eff="@effective-date",
     title="citeertitel | intitule", rank="wetgeving@soort", rank_else="other",
     ranks={"wet": "wet", "rijkswet": "rijkswet", "AMvB": "amvb", "rijksAMvB": "rijks_amvb", "ministeriele-regeling": "ministeriele_regeling", "ministeriele-regeling-archiefselectielijst": "archiefselectielijst", "ministeriele-regeling-BES": "ministeriele_regeling_bes", "KB": "kb", "rijksKB": "rijks_kb", "verdrag": "verdrag", "zbo": "zbo", "pbo": "pbo", "beleidsregel": "beleidsregel", "beleidsregel-BES": "beleidsregel_bes", "circulaire": "circulaire", "circulaire-BES": "circulaire_bes", "reglement": "reglement", "wet-BES": "wet_bes", "AMvB-BES": "amvb_bes"})

_add("eu", "xml", [("*.title-division-*", "head:division"), (".eli-subdivision", "unit:article")], envelope="version", uid="@id", heading=".title-article-norm | .stitle-article-norm", paras=".norm",
     src="@source-id", pub="@effective-date", eff="@effective-date", title="eurlex-multi-version@title", rank="eurlex-multi-version@rtype", rank_key="([A-Z_]+)$",
     ranks={"REG": "regulation", "REG_IMPL": "implementing_regulation", "REG_DEL": "delegated_regulation", "REG_FINANC": "financial_regulation", "DIR": "directive", "DIR_IMPL": "implementing_directive", "DIR_DEL": "delegated_directive", "DEC": "decision", "DEC_IMPL": "implementing_decision", "DEC_DEL": "delegated_decision", "DEC_ENTSCHEID": "decision_sui_generis", "RECO": "recommendation", "TREATY": "treaty", "AGREE_INTERNATION": "international_agreement"},
     states=(("eurlex-multi-version[force=0][repealedby]", "repealed"), ("eurlex-multi-version[force=0]", "expired")))

_add("fi", "xml", _AKN_RULES, body="body", **_AKN, pub="frbrwork/frbrdate[name=datePublished]@date | frbrwork/frbrdate[name=dateIssued]@date", src="docnumber", title="doctitle", rank="proprietary/typestatute@refersto", rank_key="([a-z-]+)$",
     ranks={"act": "laki", "decree": "asetus", "order": "maarays", "government-decree": "valtioneuvoston_asetus", "ministerial-decree": "ministerion_asetus", "presidential-decree": "tasavallan_presidentin_asetus"},
     states=(("proprietary/isinforce[value=false]", "repealed"),))

_add("ch", "xml", [("preface", "skip"), ("meta", "skip"), ("part", "head+:part"), ("title", "head+:title"), ("chapter", "head+:chapter"), ("article", "unit:article")], envelope="version", body="body", **_AKN, pub="@publication-date | @effective-date", eff="@effective-date", title="frbrname@value", rank="frbrname@value", rank_is="contains", rank_else="andere",
     ranks={"Bundesverfassung": "bundesverfassung", "Kantonsverfassung": "kantonsverfassung", "Zivilgesetzbuch": "bundesgesetz", "Strafgesetzbuch": "bundesgesetz", "prozessordnung": "bundesgesetz", "Obligationenrecht": "bundesgesetz", "Bundesbeschluss": "bundesbeschluss", "Bundesgesetz": "bundesgesetz", "Verordnung": "verordnung", "Reglement": "reglement", "gesetz": "bundesgesetz"})

_add("lu", "xml", _AKN_RULES, envelope="version", body="body", **_AKN, pub="@effective-date | jolux/publicationdate", eff="@effective-date", title="jolux/title | longtitle", rank="jolux/typedocument", rank_key="([A-Za-z]+)$",
     ranks={"LOI": "loi", "RGD": "reglement_grand_ducal", "AGD": "arrete_grand_ducal", "AMIN": "arrete_ministeriel", "RMIN": "reglement_ministeriel", "Constitution": "constitution", "CODE": "code", "CONV": "convention", "TC": "traite", "ORD": "ordonnance", "DEC": "decision"},
     states=(("jolux/status~no-longer-in-force$", "repealed"),))

_add("de", "xml", [("norm~^$", "skip"), ("norm[doknr=*-head]", "skip"), ("norm", "unit:article")], uid="@doknr", heading="enbez + titel | gliederungsbez + gliederungstitel", paras="content/p", pub="ausfertigung-datum | @builddate", title="langue", department="fundstelle/periodikum",
     rank="langue", rank_is="contains", rank_else="bundesgesetz", ranks={"grundgesetz": "grundgesetz", "verordnung": "rechtsverordnung", "bekanntmachung": "bekanntmachung", "satzung": "satzung"})

_add("dk", "xml", [("meta", "skip"), ("bog", "head+:book"), ("afsnit", "head+:part"), ("kapitel", "head+:chapter"), ("paragraf", "unit:article"), ("nota", "unit:note")], uid="@id", heading="explicatus + rubrica", paras="linea", pub="meta/diesedicti | meta/diessigni", src="meta/accessionnumber", title="meta/documenttitle", department="meta/ministry", rank="meta/documenttype",
     ranks={"LOV H": "lov", "LOV Æ": "aendringslov", "LBK H": "lovbekendtgoerelse", "BEK H": "bekendtgoerelse", "BEK Æ": "bekendtgoerelse_aendring", "Lov": "lov"}, states=(("meta/status~^Historic$", "repealed"),))

_add("ee", "xml", [("metaandmed", "skip"), ("osa", "head+:part"), ("peatykk", "head+:chapter"), ("jagu", "head+:division"), ("jaotis", "head+:subdivision"), ("paragrahv", "unit:article")], uid="@id | paragrahvnr", heading="paragrahvnr + paragrahvpealkiri | peatykknr + peatykkpealkiri | osanr + osapealkiri | jagunr + jagupealkiri", paras="tavatekst", pub="kehtivus/kehtivusealgus", src="globaalid", title="nimi/pealkiri | pealkiri", department="valjaandja", rank="dokumentliik",
     ranks={"seadus": "seadus", "määrus": "maarus", "korraldus": "korraldus", "otsus": "otsus", "seadlus": "seadlus", "valisleping": "valisleping"}, states=(("kehtivus/kehtivuselopp~^(19|200|201)", "repealed"),))

_add("at", "xml", [("nutzdaten", "unit:paragraph")], uid="absatz[ct=doknr]", heading="absatz[ct=artikel_anlage]", paras="absatz[ct=text]", src="absatz[ct=kundmachungsorgan]", pub="absatz[ct=ikra]", title="absatz[ct=kurztitel]", rank="absatz[ct=typ]", expiry="absatz[ct=akra]",
     ranks={"BVG": "bundesverfassungsgesetz", "G": "bundesgesetz", "V": "verordnung", "K": "kundmachung", "E": "erlass", "Vertrag": "staatsvertrag"}, states=(("absatz[ct=akra]~^[0-9]", "repealed"),))

_add("cl", "xml", [("encabezado", "skip"), ("promulgacion", "unit:promulgation"), ("estructurafuncional[tipoparte=Artículo]", "unit:article"), ("estructurafuncional", "head+:@tipoparte"), ("anexo", "unit:annex")], uid="@idparte", heading="metadatos/tituloparte | metadatos/nombreparte", paras="texto", pub="@fechaversion | identificador@fechapublicacion", eff="@fechaversion | norma@fechaversion", group="rows", title="titulonorma", department="organismo", rank="tiponumero/tipo",
     ranks={"Ley": "ley", "Código": "codigo", "Decreto con Fuerza de Ley": "decreto_con_fuerza_de_ley", "Decreto Ley": "decreto_ley", "Decreto": "decreto", "Decreto Supremo": "decreto_supremo", "Tratado Internacional": "tratado", "Ley Orgánica Constitucional": "ley_organica_constitucional", "Ley de Quórum Calificado": "ley_quorum_calificado", "Ley Interpretativa": "ley_interpretativa", "Resolución": "resolucion", "Reglamento": "reglamento", "Mensaje": "mensaje"}, states=(("norma[derogado=derogado]", "repealed"),))

_add("us", "xml", [("meta", "skip"), ("title", "head+:title"), ("chapter", "head+:chapter"), ("section", "unit:section")], body="main | .", uid="@identifier", heading="num + heading", paras="content/p | content | p", pub="meta/created", title="meta/title", rank="meta/docpublicationname", ranks={"United States Code": "usc-title"}, rank_else="usc-title")

_add("ie", "xml", [("metadata", "skip"), ("part", "head+:part"), ("chapter", "head+:chapter"), ("sect", "unit:section"), ("schedule", "unit:schedule")], body="body | .", uid="@id", heading="number + title", paras="p", pub="metadata/dateofenactment", src="metadata/number", title="metadata/title", rank="act@type", ranks={"public": "act", "private": "private-act"}, rank_else="act")

_add("no", "html", [("header", "skip"), (".changesToParent", "skip"), (".legalArticleHeader", "skip"), ("h2", "head:part"), ("h3", "head:chapter"), ("article.legalArticle", "unit:article")], body="main.documentBody", uid="@id | @data-name", heading=".legalArticleHeader", paras=".legalP", pub="dd.dateInForce", title="dd.title | h1", department="dd.ministry", rank="dd.legacyID", rank_key="^([A-Z]+)", ranks={"LOV": "lov", "FOR": "forskrift"})

_add("be", "json", [("a[name=LNK*]", "head:heading"), ("a[name=Art.*]", "head:article"), ("p", "para"), ("sup", "skip")], envelope="versions", inner="html text_b64", packed=True, uid="@name", pub="effective_date", eff="effective_date", src="archive_id", title="title", rank="dt", encoding="utf-8-sig",
     ranks={"constitution": "constitution", "loi": "loi", "decret": "decret", "ordonnance": "ordonnance", "arrete": "arrete_royal"})

_add("ro", "json", [("*.S_TTL", "head:title"), ("*.S_CAP", "head:chapter"), ("*.S_SEC", "head:section"), (".S_ART", "unit:article"), (".S_NTA", "skip")], envelope="versions", inner="html text_b64", packed=True, uid="@id", heading=".S_ART_TTL", paras=".S_ART_BDY | .S_ALN_BDY | .S_PAR", pub="date", eff="date", title="title", rank="title", rank_is="folded", rank_key="^(\\w+)", ranks={"constitutia": "constitutie", "ordonanta": "ordonanta", "hotarare": "hotarare", "decret": "decret", "lege": "lege", "cod": "cod"}, rank_else="lege")

_add("li", "json", [(".htit1", "skip"), (".htit2", "skip"), (".vom", "skip"), (".inheintrag", "skip"), (".tit1m", "head:part"), (".tit1", "head:title"), (".tit2", "head:subtitle"), (".art", "unit:article")], envelope="versions", inner="html html", uid="@id", heading=".artnr | .sacht", paras=".ab | .abs", pub="date_text", eff="date_text", title="title", rank="title", rank_is="contains", rank_else="norm",
     ranks={"verfassungsgesetz": "verfassungsgesetz", "verfassung ": "verfassung", "personen- und gesellschaftsrecht": "gesetz", "staatsvertrag": "staatsvertrag", "notenaustausch": "notenaustausch", "abkommen": "abkommen", "übereinkommen": "uebereinkommen", "konvention": "konvention", "protokoll": "protokoll", "kundmachung": "kundmachung", "verordnung": "verordnung", "regierungsbeschluss": "regierungsbeschluss", "beschluss": "beschluss", "erklärung": "erklaerung", "vereinbarung": "vereinbarung", "reglement": "reglement", "ordnung": "ordnung", "statut": "statut", "gesetz": "gesetz"})

_add("lt", "json", [("line~^([IVXLCDM]+) (?:skyrius|SKYRIUS)", "head:chapter"), ("line~^([0-9]+) straipsnis", "head:article"), ("line~.", "para")], envelope="_data", inner="text tekstas_lt", uid="", pub="galioja_nuo | priimtas", eff="galioja_nuo", src="suvestines_id | dokumento_id", title="pavadinimas", department="priemusi_inst", rank="rusis",
     ranks={"Konstitucija": "konstitucija", "Konstitucinis įstatymas": "konstitucinis_istatymas", "Įstatymas": "istatymas", "Kodeksas": "istatymas", "Nutarimas": "nutarimas", "Įsakymas": "isakymas", "Sprendimas": "sprendimas", "Potvarkis": "potvarkis", "Dekretas": "dekretas", "Rezoliucija": "rezoliucija"}, states=(("galioj_busena~^negalioja$", "repealed"),))

_add("lv", "html", [(".TV207", "skip"), (".TV212", "head:chapter"), (".TV214", "head:transitional"), (".TV218", "head:annex"), (".TV213", "unit:article"), (".TV208", "skip")], body=".doc-body", uid="@data-num", heading="b", paras="p", pub="span.publicets", title="h1", department="span.izdevejs", rank="a.veids@href", rank_key="/ta/veids/[^/]+/([^/]+)",
     ranks={"likumi": "likums", "konstitucionalais-likums": "konstitucionalais_likums", "noteikumi": "noteikumi", "saistosie-noteikumi": "saistosie_noteikumi", "rikojumi": "rikojums", "lemumi": "lemums", "instrukcijas": "instrukcija", "kartiba": "kartiba", "ietikumi": "ietikumi", "ligumi": "ligums", "starptautiskais-ligums": "starptautiskais_ligums", "konvencija": "konvencija", "dekreti": "dekrets", "pavelnes": "pavelne", "noradijumi": "noradijumi"}, states=((".ico-zspeku", "repealed"),))

_add("co", "html", [("div[id=toggle_*]", "unit:article")], uid="@id", heading="h4 | b", nested=".version", paras="p", pub="@data-desde | span[field=fecha]", src="span[field=numero]", title="div[id=titulotipo]/h1 | h1", department="span[field=entidad]", rank="span[field=rango]", rank_is="slug", rank_else="otro",
     states=(("span[field=vigencia]~(?i)parcial", "partially_repealed"), ("span[field=vigencia]~(?i)derog|no vigente", "repealed")))

_add("cz", "json", [("seznam~Virtual_|Prefix_", "skip"), ("seznam~\"(?:Cast|Hlava|Dil|Oddil)\"", "skip"), ("seznam", "unit:fragment")], uid="@id | fragmentid", heading="kodtypufragmentu", paras="xhtml", pub="datumcasvyhlaseni | datumucinnostiod", src="kodcitace", title="nazev", rank="sablonahierarchiekod", rank_is="contains", rank_else="unknown",
     ranks={"_UST": "constitutional_law", "_ZAKON": "law", "_NARIZENI": "regulation", "_VYHLASKA": "ordinance", "_DEKRET": "decree"}, states=(("stavdokumentusbirky~ZRUS|NEUCIN", "repealed"),))

_add("it", "json", [("articles", "unit:article")], uid="article_num", heading="article_num", paras="html", pub="vigenza_inizio | atto_metadata/dataemanazione", eff="vigenza_inizio", group="rows", src="codiceredazionale", title="atto_metadata/titolo", rank="atto_metadata/tipoprovvedimentodescrizione",
     ranks={"COSTITUZIONE": "costituzione", "LEGGE COSTITUZIONALE": "legge_costituzionale", "LEGGE": "legge", "DECRETO LEGISLATIVO": "decreto_legislativo", "DECRETO-LEGGE": "decreto_legge", "DECRETO DEL PRESIDENTE DELLA REPUBBLICA": "decreto_presidente_repubblica", "DECRETO DEL PRESIDENTE DEL CONSIGLIO DEI MINISTRI": "decreto_presidente_consiglio", "DECRETO": "decreto", "DECRETO MINISTERIALE": "decreto_ministeriale", "ORDINANZA": "ordinanza", "DELIBERAZIONE": "deliberazione", "REGOLAMENTO": "regolamento", "REGIO DECRETO": "regio_decreto", "REGIO DECRETO-LEGGE": "regio_decreto_legge", "DECRETO LUOGOTENENZIALE": "decreto_luogotenenziale", "REGIO DECRETO LEGISLATIVO": "regio_decreto_legislativo", "DECRETO LEGISLATIVO LUOGOTENENZIALE": "decreto_legislativo_luogotenenziale", "DECRETO PRESIDENZIALE": "decreto_presidenziale", "DECRETO REALE": "decreto_reale"})

_add("pl", "json", [(".unit_chpt", "head+:chapter"), (".unit_dzia", "head+:division"), (".unit_arti", "unit:article"), (".unit_para", "unit:article")], inner="html html", uid="@data-id | @id", heading="h3", paras=".pro-text", pub="announcementdate", src="eli", title="title", department="releasedby", rank="type", rank_is="folded", rank_key="^(\\w+)",
     ranks={"konstytucja": "konstytucja", "ustawa": "ustawa", "rozporzadzenie": "rozporzadzenie", "obwieszczenie": "obwieszczenie", "uchwala": "uchwala", "zarzadzenie": "zarzadzenie", "postanowienie": "postanowienie", "decyzja": "decyzja", "umowa": "umowa_miedzynarodowa", "protokol": "umowa_miedzynarodowa", "kodeks": "kodeks", "dekret": "dekret", "orzeczenie": "orzeczenie", "wyrok": "wyrok", "komunikat": "komunikat", "oswiadczenie": "oswiadczenie"},
     states=(("inforce~^(REPEALED|UCHYLONY)$", "repealed"), ("inforce~^PARTIALLY_REPEALED$", "partially_repealed"), ("inforce~^ANNULLED$", "annulled"), ("inforce~^(EXPIRED|NOT_IN_FORCE)$", "expired")))

_add("pt", "json", [("fragments", "unit:fragment")], envelope="versions", uid="fragmentoid", heading="tituo | epigrafe", paras="texto", pub="date", eff="date", src="amending/legis_id", title="published/titulo", department="published/emissor", rank="published/eli", rank_key="/eli/([a-z]+(?:-[a-z]+)*)/",
     ranks={"lei": "lei", "lei-constitucional": "lei-constitucional", "leiorg": "lei-organica", "dec-lei": "decreto-lei", "dec": "decreto", "decregul": "decreto-regulamentar", "declegreg": "decreto-legislativo-regional", "decregulreg": "decreto-regulamentar-regional", "port": "portaria", "resol": "resolucao", "resolconsmin": "resolucao-conselho-ministros", "resolassrep": "resolucao-assembleia-republica", "despnorm": "despacho-normativo", "decpresrep": "decreto-presidente-republica", "declrectif": "declaracao-rectificacao", "declretif": "declaracao-retificacao"},
     states=(("vigencia~^NAO_VIGENTE$", "repealed"), ("vigencia~^VIGENCIA_CONDICIONADA$", "partially_repealed"), ("vigencia~^CADUCADO$", "expired")))

_add("se", "json", [("a[name=K*P*]", "head:section"), ("h3", "head:chapter"), ("p", "para")], inner="html dokument/html", uid="@name", pub="dokument/datum", src="dokument/beteckning", title="dokument/titel", department="dokument/organ", rank="dokument/titel", rank_is="contains", rank_else="lag",
     ranks={"grundlag": "grundlag", "regeringsform": "grundlag", "tryckfrihetsförordning": "grundlag", "successionsordning": "grundlag", "balk": "balk", "förordning": "forordning"})

_add("sk", "json", [(".hlavaNadpis", "head:title"), (".hlavaOznacenie", "skip"), (".paragraf", "unit:article"), (".clanok", "unit:article")], envelope="versions", inner="html html", uid="@id", heading=".paragrafOznacenie | .clanokOznacenie", paras=".text", pub="date", eff="date", src="amendment", title="docs/nazov", rank="docs/typpredp",
     ranks={"UstavnyZakon": "constitutional_law", "Zakon": "law", "NariadenieVlady": "government_regulation", "Vyhlaska": "ordinance", "Oznamenie": "notification", "Nalez": "finding", "Opatrenie": "measure", "Rozhodnutie": "decision", "Uznesenie": "resolution", "ZakonneOpatrenie": "legal_measure", "RedakcneOznamenie": "editorial_notification", "ZakonCeleZnenie": "law"}, states=(("docs/ucinnydo~^[0-9]", "repealed"),))

_add("ua", "json", [("line~^Розділ\\s+([IVXLCDM\\d]+)", "head:chapter"), ("line~^Глава\\s+(\\d+)", "head:subchapter"), ("line~^Стаття\\s+(\\d+)", "head:article"), ("line~^Додаток", "head:annex"), ("line~^\\{.*\\}$", "skip"), ("line~.", "para")], envelope="eds", inner="text txt", pub="datred", eff="datred", src="pidstava", title="card/nazva", department="card/organs", rank="card/types", rank_key="^([^,]+)", rank_else="zakon",
     ranks={"Конституція": "konstytutsiia", "Конституція України": "konstytutsiia", "Закон": "zakon", "Кодекс": "kodeks", "Кодекс України": "kodeks", "Указ": "ukaz", "Декрет": "dekret", "Постанова": "postanova", "Розпорядження": "rozporiadzhennia"},
     states=(("card/stan~^(Нечинний|Втратив чинність)$", "repealed"),))

_add("uy", "json", [("articulos", "unit:article")], uid="nroarticulo", heading="tituloarticulo | nroarticulo", paras="textoarticulo", pub="fechapublicacion", src="nronorma", title="nombrenorma", department="firmantes", rank="tiponorma", encoding="iso-8859-1",
     ranks={"ley": "ley", "decreto ley": "decreto_ley", "decreto-ley": "decreto_ley", "decreto": "decreto", "constitucion": "constitucion", "constitucion de la republica": "constitucion", "codigo": "codigo", "codigo civil": "codigo", "codigo penal": "codigo", "codigo tributario": "codigo", "codigo de comercio": "codigo"}, rank_is="folded")

_add("ad", "html", [("p.Titol-3", "skip"), ("p.Titol-4", "head:title"), ("p.Titol-5", "head:chapter"), ("p.Titol-6", "head:article"), ("p.signatura", "skip"), ("p.Data", "skip"), ("p.Body-text*", "para")], pub="p.Data", title="p.Titol-3", rank="meta[name=organisme]@content", rank_else="otro",
     ranks={"Lleis": "llei", "Reglaments": "reglament", "Legislació delegada": "decret_llei", "Constitució del Principat d'Andorra": "constitucio"})

_add("ar", "html", [("a[name]", "head:heading"), ("p~(?i)^(?:ART[ÍI]?CULO|ART\\.?)\\s+(\\d+(?:\\s*bis|\\s*ter)?)\\s*[°º.]?[\\s.–—-]*(.*)$", "head:article"), ("table", "skip"), ("p", "para")], pub="span.vr_azul11", title="h1", rank="h2", rank_key="^(\\D+?)\\s*\\d*$", encoding="windows-1252",
     ranks={"Ley": "ley", "Decreto": "decreto", "Decreto/Ley": "decreto_ley", "Decisión Administrativa": "decision_administrativa", "Resolución": "resolucion", "Disposición": "disposicion", "Comunicación": "comunicacion", "Acordada": "acordada", "Directiva": "directiva", "Decisión": "decision", "Instrucción": "instruccion", "Nota Externa": "nota_externa", "Nota": "nota", "Circular": "circular", "Acta": "acta", "Recomendación": "recomendacion", "Laudo": "laudo", "Convenio": "convenio", "Acuerdo": "acuerdo", "Providencia": "providencia", "Protocolo": "protocolo", "Ordenanza": "ordenanza", "Interpretación": "interpretacion", "Actuacion": "actuacion"})

_add("gr", "json", [("line~^ΚΕΦΑΛΑΙΟ\\s+(\\S+)", "head:chapter"), ("line~^Άρθρο\\s+(\\d+)", "head:article"), ("line~.", "para")], inner="text text", pub="search/publicationdate", src="search/fekid", title="search/title", rank="tags/topic", rank_else="otro", month_first=True,
     ranks={"Νόμος": "nomos", "Νόμοι": "nomos", "Προεδρικό Διάταγμα": "proedriko_diatagma", "Προεδρικά Διατάγματα": "proedriko_diatagma", "Πράξη Νομοθετικού Περιεχομένου": "praxi_nomothetikou_periechomenou", "Πράξεις Νομοθετικού Περιεχομένου": "praxi_nomothetikou_periechomenou", "Νομοθετικό Διάταγμα": "nomothetiko_diatagma", "Αναγκαστικός Νόμος": "anagastikos_nomos", "Βασιλικό Διάταγμα": "vasiliko_diatagma", "Σύνταγμα": "syntagma", "Πράξη Υπουργικού Συμβουλίου": "praxi_ypourgikou_symvouliou", "Κανονισμός": "kanonismos", "Απόφαση": "apofasi"})


@dataclass(frozen=True)
class Sample:
    text: str
    rank: str
    rows: tuple[tuple[str | None, ...], ...]
    status: str = "in_force"


SAMPLES: dict[str, Sample] = {}


def _sample(code: str, text: str, rank: str, *rows, status: str = "in_force") -> None:
    SAMPLES[code] = Sample(text, rank, rows, status)


_sample("es", """<?xml version="1.0" encoding="utf-8"?>
<documento fecha_actualizacion="{next8}"><metadatos><identificador>BOE-A-{id}</identificador><titulo>{title}</titulo><departamento codigo="7723">Jefatura del Estado</departamento><rango codigo="1300">Ley</rango><fecha_publicacion>{day8}</fecha_publicacion><estatus_derogacion>P</estatus_derogacion></metadatos><texto>
<bloque id="a1" tipo="precepto" titulo="Artículo 1"><version id_norma="BOE-A-{id}" fecha_publicacion="{day8}" fecha_vigencia="{day8}"><p class="articulo">Artículo 1.</p><p class="parrafo">{one}</p></version><version id_norma="BOE-B-{id}" fecha_publicacion="{day8}" fecha_vigencia="{next8}"><p class="parrafo">{later}</p></version></bloque>
<bloque id="a2" tipo="precepto" titulo="Artículo 2" fecha_caducidad="99991231"><version id_norma="BOE-A-{id}" fecha_publicacion="{day8}"><p class="parrafo">{two}</p></version></bloque></texto></documento>""", "ley",
        ("a1", "precepto", "Artículo 1", "BOE-A-{id}", "{day}", "Artículo 1.\n\n{one}"), ("a1", "precepto", "Artículo 1", "BOE-B-{id}", "{next}", "{later}"), ("a2", "precepto", "Artículo 2", "BOE-A-{id}", "{day}", "{two}"), status="partially_repealed")

_sample("fr", """<legi_combined id="LEGITEXT{id}"><META><NATURE>CODE</NATURE><TITREFULL>{title}</TITREFULL><ETAT>VIGUEUR</ETAT></META><elements>
<section id="S{id}" titre="Titre premier" niv="1" debut="{day}" fin="2999-01-01" etat="VIGUEUR"/>
<article id="A1" cid="C1" num="1" debut="{day}" fin="{next}" etat="MODIFIE"><CONTENU><p>{one}</p></CONTENU></article>
<article id="A1b" cid="C1" num="1" debut="{next}" fin="2999-01-01" etat="VIGUEUR"><CONTENU><p>{later}</p></CONTENU><source_modif id="JORF{id}" date="{next}" nature="LOI"/></article>
<article id="A2" cid="C2" num="2" debut="{day}" fin="{next}" etat="ABROGE"><CONTENU><p>{two}</p></CONTENU></article></elements></legi_combined>""", "code",
        ("S{id}", "section", "Titre premier", "S{id}", "{day}", ""), ("C1", "article", "1", "A1", "{day}", "{one}"), ("C1", "article", "1", "JORF{id}", "{next}", "{later}"), ("C2", "article", "2", "A2", "{day}", "{two}"), ("C2", "article", "2", "A2", "{next}", ""))

_CLML = '<Legislation><Primary><Body><Part id="part-1"><Number>PART 1</Number><Title>General</Title><P1 id="section-1"><Pnumber>1</Pnumber><P1para><Text>%s</Text></P1para></P1><P1 id="section-2"><Pnumber>2</Pnumber><P1para><Text>{two}</Text></P1para></P1></Part></Body></Primary></Legislation>'
_sample("uk", '{"norm_id": "ukpga-{id}", "title": "{title}", "type": "UnitedKingdomPublicGeneralAct", "versions": [{"effective_date": "{day}", "xml_b64": ' + repr(_CLML % "{one}").replace('"', '\\"').replace("'", '"') + '}, {"effective_date": "{next}", "xml_b64": ' + repr(_CLML % "{later}").replace('"', '\\"').replace("'", '"') + "}]}", "public-general-act",
        ("part-1", "part", "PART 1 General", None, "{day}", ""), ("section-1", "section", "1", None, "{day}", "{one}"), ("section-2", "section", "2", None, "{day}", "{two}"), ("section-1", "section", "1", None, "{next}", "{later}"))

_BWB = '<toestand bwb-id="BWBR{id}"><wetgeving soort="wet"><intitule>Lange titel</intitule><citeertitel>{title}</citeertitel><wet-besluit><wettekst><hoofdstuk label-id="h1"><kop><label>Hoofdstuk</label></kop><artikel label-id="art1" bron="Stb."><kop><nr>1</nr></kop><al>%s</al></artikel><artikel label-id="art2" bron="Stb."><kop><nr>2</nr></kop><lid><lidnr>1</lidnr><al>{two}</al></lid></artikel></hoofdstuk></wettekst></wet-besluit></wetgeving></toestand>'
_sample("nl", '<bwb-envelope><expression effective-date="{day}">' + _BWB % "{one}" + '</expression><expression effective-date="{next}">' + _BWB % "{later}" + "</expression></bwb-envelope>", "wet",
        ("h1", "chapter", "Hoofdstuk", None, "{day}", ""), ("art1", "article", "1", "Stb.", "{day}", "{one}"), ("art2", "article", "2", "Stb.", "{day}", "{two}"), ("art1", "article", "1", "Stb.", "{next}", "{later}"))

_XHTML = '<html><body><p class="title-division-1">TITLE I</p><div class="eli-subdivision" id="art_1"><p class="title-article-norm">Article 1</p><div class="norm">%s</div></div><div class="eli-subdivision" id="art_2"><p class="title-article-norm">Article 2</p><div class="norm">{two}</div></div></body></html>'
_sample("eu", '<eurlex-multi-version celex="3{id}" title="{title}" rtype="http://publications.europa.eu/resource/authority/resource-type/DIR_IMPL" force="1"><version type="original" source-id="3{id}" effective-date="{day}">' + _XHTML % "{one}" + '</version><version type="consolidated" source-id="0{id}" effective-date="{next}">' + _XHTML % "{later}" + "</version></eurlex-multi-version>", "implementing_directive",
        ("division-1", "division", "TITLE I", "3{id}", "{day}", ""), ("art_1", "article", "Article 1", "3{id}", "{day}", "{one}"), ("art_2", "article", "Article 2", "3{id}", "{day}", "{two}"), ("art_1", "article", "Article 1", "0{id}", "{next}", "{later}"))

_BODY = '<body><chapter eId="chp_1"><num>I</num><heading>General</heading><%s eId="a1"><num>1</num><paragraph><content><p>%s</p></content></paragraph></%s><%s eId="a2"><num>2</num><paragraph><content><p>{two}</p></content></paragraph></%s></chapter></body>'


def _akn(unit: str, text: str, meta: str) -> str:
    return f"<akomaNtoso><act><meta>{meta}</meta>{_BODY % (unit, text, unit, unit, unit)}</act></akomaNtoso>"


_sample("fi", _akn("section", "{one}", '<identification><FRBRWork><FRBRdate name="dateIssued" date="{day}"/></FRBRWork></identification><proprietary><finlex:typeStatute refersTo="#act"/><finlex:isInForce value="true"/></proprietary>').replace("<act>", "<act><preface><docNumber>{id}</docNumber><docTitle>{title}</docTitle></preface>"), "laki",
        ("chp_1", "chapter", "I General", "{id}", "{day}", ""), ("a1", "article", "1", "{id}", "{day}", "{one}"), ("a2", "article", "2", "{id}", "{day}", "{two}"))

_NAME = '<identification><FRBRWork><FRBRname xml:lang="de" value="Bundesgesetz {title}"/></FRBRWork></identification>'
_sample("ch", '<fedlex-multi-version norm-id="{id}"><version type="consolidation" effective-date="{day}">' + _akn("article", "{one}", _NAME) + '</version><version type="consolidation" effective-date="{next}">' + _akn("article", "{later}", _NAME) + "</version></fedlex-multi-version>", "bundesgesetz",
        ("chp_1", "chapter", "I General", None, "{day}", ""), ("a1", "article", "1", None, "{day}", "{one}"), ("a2", "article", "2", None, "{day}", "{two}"), ("a1", "article", "1", None, "{next}", "{later}"))

_JOLUX = "<scl:jolux><scl:title>{title}</scl:title><scl:typeDocument>http://data.legilux.public.lu/resource/authority/resource-type/RGD</scl:typeDocument></scl:jolux>"
_sample("lu", '<legilux-multi-version norm-id="{id}"><version type="original" effective-date="{day}">' + _akn("article", "{one}", _JOLUX) + '</version><version type="consolidation" effective-date="{next}">' + _akn("article", "{later}", _JOLUX) + "</version></legilux-multi-version>", "reglement_grand_ducal",
        ("chp_1", "chapter", "I General", None, "{day}", ""), ("a1", "article", "1", None, "{day}", "{one}"), ("a2", "article", "2", None, "{day}", "{two}"), ("a1", "article", "1", None, "{next}", "{later}"))

_sample("de", """<dokumente builddate="{next8}000000" doknr="BJNR{id}"><norm doknr="BJNR{id}-head"><metadaten><jurabk>X</jurabk><ausfertigung-datum>{day}</ausfertigung-datum><langue>Verordnung {title}</langue></metadaten></norm>
<norm doknr="N1"><metadaten><enbez>§ 1</enbez></metadaten><textdaten><text format="XML"><Content><P>{one}</P><P>{later}</P></Content></text></textdaten></norm>
<norm doknr="N2"><metadaten><enbez>§ 2</enbez></metadaten><textdaten><text format="XML"><Content><P>{two}</P></Content></text></textdaten></norm></dokumente>""", "rechtsverordnung",
        ("N1", "article", "§ 1", None, "{day}", "{one}\n\n{later}"), ("N2", "article", "§ 2", None, "{day}", "{two}"))

_sample("dk", """<Dokument><Meta><DocumentType>LBK H</DocumentType><DocumentTitle>{title}</DocumentTitle><AccessionNumber>B{id}</AccessionNumber><DiesEdicti>{day}</DiesEdicti><Status>Historic</Status></Meta><DokumentIndhold>
<Kapitel id="K1"><Rubrica>Kapitel 1</Rubrica><ParagrafGruppe><Paragraf id="P1"><Explicatus>§ 1.</Explicatus><Stk><Exitus><Linea><Char>{one}</Char></Linea></Exitus></Stk></Paragraf><Paragraf id="P2"><Explicatus>§ 2.</Explicatus><Stk><Exitus><Linea><Char formaChar="Bold">{two}</Char></Linea></Exitus></Stk></Paragraf></ParagrafGruppe></Kapitel></DokumentIndhold></Dokument>""", "lovbekendtgoerelse",
        ("K1", "chapter", "Kapitel 1", "B{id}", "{day}", ""), ("P1", "article", "§ 1.", "B{id}", "{day}", "{one}"), ("P2", "article", "§ 2.", "B{id}", "{day}", "{two}"), status="repealed")

_sample("ee", """<oigusakt xmlns="tyviseadus_1_10.02.2010"><metaandmed><valjaandja>Riigikogu</valjaandja><dokumentLiik>määrus</dokumentLiik><globaalID>{id}</globaalID><kehtivus><kehtivuseAlgus>{day}+02:00</kehtivuseAlgus></kehtivus></metaandmed><aktinimi><nimi><pealkiri>{title}</pealkiri></nimi></aktinimi><sisu>
<peatykk id="ptk1"><peatykkNr>1</peatykkNr><paragrahv id="para1"><paragrahvNr>1</paragrahvNr><loige id="l1"><sisuTekst><tavatekst>{one}</tavatekst></sisuTekst></loige></paragrahv><paragrahv id="para2"><paragrahvNr>2</paragrahvNr><loige><sisuTekst><tavatekst>{two}</tavatekst></sisuTekst></loige></paragrahv></peatykk></sisu></oigusakt>""", "maarus",
        ("ptk1", "chapter", "1", "{id}", "{day}", ""), ("para1", "article", "1", "{id}", "{day}", "{one}"), ("para2", "article", "2", "{id}", "{day}", "{two}"))

_NOR = '<risdok xmlns="http://www.bka.gv.at"><nutzdaten><abschnitt><absatz typ="abs" ct="kurztitel">{title}</absatz><absatz typ="abs" ct="kundmachungsorgan">BGBl. {id}</absatz><absatz typ="abs" ct="typ">G</absatz><absatz typ="abs" ct="artikel_anlage">%s</absatz><absatz typ="abs" ct="ikra">{daydot}</absatz><absatz typ="abs" ct="doknr">%s</absatz><absatz typ="abs" ct="text">%s</absatz></abschnitt></nutzdaten></risdok>'
_sample("at", "<combined_nor_documents>" + _NOR % ("§ 1", "NOR1", "{one}") + _NOR % ("§ 2", "NOR2", "{two}") + "</combined_nor_documents>", "bundesgesetz",
        ("NOR1", "paragraph", "§ 1", "BGBl. {id}", "{day}", "{one}"), ("NOR2", "paragraph", "§ 2", "BGBl. {id}", "{day}", "{two}"))

_sample("cl", """<Norma xmlns="http://www.leychile.cl/esquemas" normaId="{id}" derogado="no derogado" fechaVersion="{day}"><Identificador fechaPublicacion="{day}"><TiposNumeros><TipoNumero><Tipo>Decreto Ley</Tipo><Numero>{id}</Numero></TipoNumero></TiposNumeros><Organismos><Organismo>MINISTERIO</Organismo></Organismos></Identificador><Metadatos><TituloNorma>{title}</TituloNorma></Metadatos><Encabezado fechaVersion="{day}"><Texto>Encabezado</Texto></Encabezado>
<EstructurasFuncionales><EstructuraFuncional tipoParte="Capítulo" idParte="c1" fechaVersion="{day}"><Texto>Capítulo I</Texto><Metadatos><TituloParte>Normas</TituloParte></Metadatos><EstructurasFuncionales><EstructuraFuncional tipoParte="Artículo" idParte="e1" fechaVersion="{next}"><Texto>{one}</Texto><Metadatos><NombreParte>1</NombreParte></Metadatos></EstructuraFuncional><EstructuraFuncional tipoParte="Artículo" idParte="e2" fechaVersion="{day}"><Texto>{two}</Texto><Metadatos><NombreParte>2</NombreParte></Metadatos></EstructuraFuncional></EstructurasFuncionales></EstructuraFuncional></EstructurasFuncionales></Norma>""", "decreto_ley",
        ("c1", "Capítulo", "Normas", None, "{day}", ""), ("e1", "article", "1", None, "{next}", "{one}"), ("e2", "article", "2", None, "{day}", "{two}"))

_sample("us", """<uscDoc><meta><dc:title>{title}</dc:title><docPublicationName>United States Code</docPublicationName><dcterms:created>{day}T00:00:00</dcterms:created></meta><main><title identifier="/us/usc/t1"><num value="1">Title 1</num><chapter identifier="/us/usc/t1/ch1"><num value="1">CHAPTER 1</num><section identifier="/us/usc/t1/s1"><num value="1">§ 1.</num><content><p>{one}</p></content><sourceCredit>(Credit)</sourceCredit></section><section identifier="/us/usc/t1/s2"><num value="2">§ 2.</num><content>{two}</content></section></chapter></title></main></uscDoc>""", "usc-title",
        ("/us/usc/t1", "title", "Title 1", None, "{day}", ""), ("/us/usc/t1/ch1", "chapter", "CHAPTER 1", None, "{day}", ""), ("/us/usc/t1/s1", "section", "§ 1.", None, "{day}", "{one}"), ("/us/usc/t1/s2", "section", "§ 2.", None, "{day}", "{two}"))

_sample("ie", """<act type="public"><metadata><title>{title}</title><number>{id}</number><dateofenactment>{day8}</dateofenactment></metadata><body><part id="part1"><title>PART 1</title><sect id="sec1"><number>1.</number><p>{one}</p></sect><sect id="sec2"><number>2.</number><p>{two}</p><p>{later}</p></sect></part></body></act>""", "act",
        ("part1", "part", "PART 1", "{id}", "{day}", ""), ("sec1", "section", "1.", "{id}", "{day}", "{one}"), ("sec2", "section", "2.", "{id}", "{day}", "{two}\n\n{later}"))

_sample("no", """<!DOCTYPE html><html><body><header class="documentHeader"><h1>{title}</h1><dl class="data-document-key-info"><dt class="legacyID">Datokode</dt><dd class="legacyID">FOR-{id}</dd><dt>I kraft</dt><dd class="dateInForce">{day}</dd></dl></header><main class="documentBody"><section class="section"><h2>Del I</h2><article class="legalArticle" id="k1"><h3 class="legalArticleHeader">§ 1</h3><article class="legalP">{one}</article><article class="changesToParent">Endret</article></article><article class="legalArticle" id="k2"><h3 class="legalArticleHeader">§ 2</h3><article class="legalP">{two}</article></article></section></main></body></html>""", "forskrift",
        ("part-1", "part", "Del I", None, "{day}", ""), ("k1", "article", "§ 1", None, "{day}", "{one}"), ("k2", "article", "§ 2", None, "{day}", "{two}"))

_JUSTEL = "<div><a name='LNK1'>TITRE I.</a><br><a name='Art.1'>Article 1</a><p>%s</p><a name='Art.2'>Art. 2</a><p>{two}<sup>1</sup></p></div>"
_sample("be", '{"title": "{title}", "dt": "arrete", "versions": [{"archive_id": "v1", "effective_date": "{day}", "text_b64": "' + _JUSTEL % "{one}" + '"}, {"archive_id": "v2", "effective_date": "{next}", "text_b64": "' + _JUSTEL % "{later}" + '"}]}', "arrete_royal",
        ("LNK1", "heading", "TITRE I.", "v1", "{day}", ""), ("Art.1", "article", "Article 1", "v1", "{day}", "{one}"), ("Art.2", "article", "Art. 2", "v1", "{day}", "{two}1"), ("Art.1", "article", "Article 1", "v2", "{next}", "{later}"))

_JUST = "<span class='S_CAP'>Capitolul I</span><span class='S_ART' id='id_1'><span class='S_ART_TTL'>Articolul 1</span><span class='S_ART_BDY'>%s</span></span><span class='S_ART' id='id_2'><span class='S_ART_TTL'>Articolul 2</span><span class='S_ART_BDY'>{two}</span></span>"
_sample("ro", '{"title": "LEGE {title}", "versions": [{"date": "{day}", "text_b64": "' + _JUST % "{one}" + '"}, {"date": "{next}", "text_b64": "' + _JUST % "{later}" + '"}]}', "lege",
        ("chapter-1", "chapter", "Capitolul I", None, "{day}", ""), ("id_1", "article", "Articolul 1", None, "{day}", "{one}"), ("id_2", "article", "Articolul 2", None, "{day}", "{two}"), ("id_1", "article", "Articolul 1", None, "{next}", "{later}"))

_LILEX = "<div class='htit1'>x</div><div class='tit1m'>I. Teil</div><div class='art' id='a:1'><div class='artnr'>Art. 1</div><div class='ab'>%s</div></div><div class='art' id='a:2'><div class='artnr'>Art. 2</div><div class='abs'>{two}</div></div>"
_sample("li", '{"title": "Verordnung {title}", "versions": [{"version": 1, "date_text": "{daydot}", "html": "' + _LILEX % "{one}" + '"}, {"version": 2, "date_text": "{nextdot}", "html": "' + _LILEX % "{later}" + '"}]}', "verordnung",
        ("part-1", "part", "I. Teil", None, "{day}", ""), ("a:1", "article", "Art. 1", None, "{day}", "{one}"), ("a:2", "article", "Art. 2", None, "{day}", "{two}"), ("a:1", "article", "Art. 1", None, "{next}", "{later}"))

_sample("lt", '{"_data": [{"dokumento_id": "{id}", "pavadinimas": "{title}", "rusis": "Nutarimas", "galioj_busena": "negalioja", "suvestines_id": "s1", "galioja_nuo": "{day}", "tekstas_lt": "I skyrius\\n1 straipsnis. Pirmas\\n{one}\\n2 straipsnis. Antras\\n{two}"}, {"suvestines_id": "s2", "galioja_nuo": "{next}", "tekstas_lt": "I skyrius\\n1 straipsnis. Pirmas\\n{later}\\n2 straipsnis. Antras\\n{two}"}]}', "nutarimas",
        ("I", "chapter", "I skyrius", "s1", "{day}", ""), ("1", "article", "1 straipsnis. Pirmas", "s1", "{day}", "{one}"), ("2", "article", "2 straipsnis. Antras", "s1", "{day}", "{two}"), ("1", "article", "1 straipsnis. Pirmas", "s2", "{next}", "{later}"), status="repealed")

_sample("lv", """<html><body><h1>{title}</h1><div class="pase-container"><span class="izdevejs">Saeima</span><a class="veids" href="/ta/veids/saeima/likumi">Likums</a><span class="publicets">{daydot}</span><i class="ico-zspeku"></i></div><div class="doc-body"><div class="TV207">{title}</div><div class="TV212">I nodaļa</div><div class="TV213" data-num="1"><b>1. pants.</b><p>{one}</p></div><div class="TV213" data-num="2"><b>2. pants.</b><p>{two}</p></div></div></body></html>""", "likums",
        ("chapter-1", "chapter", "I nodaļa", None, "{day}", ""), ("1", "article", "1. pants.", None, "{day}", "{one}"), ("2", "article", "2. pants.", None, "{day}", "{two}"), status="repealed")

_sample("co", """<html><body><span field="rango">LEY ORGÁNICA</span><span field="numero">{id}</span><span field="fecha">{dayslash}</span><span field="vigencia">Derogado parcialmente</span><div id="titulotipo"><h1>{title}</h1></div><div style="padding: 15px"><div id="toggle_1"><h4>ARTÍCULO 1.</h4><div class="version" data-desde="{day}"><p>{one}</p></div><div class="version" data-desde="{next}"><p>{later}</p></div></div><div id="toggle_2"><h4>ARTÍCULO 2.</h4><p>{two}</p></div></div></body></html>""", "ley_organica",
        ("toggle_1", "article", "ARTÍCULO 1.", "{id}", "{day}", "{one}"), ("toggle_1", "article", "ARTÍCULO 1.", "{id}", "{next}", "{later}"), ("toggle_2", "article", "ARTÍCULO 2.", "{id}", "{day}", "{two}"), status="partially_repealed")

_sample("cz", '{"nazev": "{title}", "datumCasVyhlaseni": "{day}T00:00:00", "sablonaHierarchieKod": "PS_NARIZENI_01", "seznam": [{"fragmentId": "f0", "kodTypuFragmentu": "Prefix_Number", "xhtml": "x"}, {"fragmentId": "f1", "kodTypuFragmentu": "Paragraf", "xhtml": "{one}"}, {"fragmentId": "f2", "kodTypuFragmentu": "Odstavec_Dc", "xhtml": "{two}"}]}', "regulation",
        ("f1", "fragment", "Paragraf", None, "{day}", "{one}"), ("f2", "fragment", "Odstavec_Dc", None, "{day}", "{two}"))

_sample("it", '{"codiceRedazionale": "{id}", "atto_metadata": {"titolo": "{title}", "tipoProvvedimentoDescrizione": "DECRETO-LEGGE", "dataEmanazione": "{day}"}, "articles": [{"article_num": "1", "vigenza_inizio": "{day8}", "html": "{one}"}, {"article_num": "1", "vigenza_inizio": "{next8}", "html": "{later}"}, {"article_num": "2", "vigenza_inizio": "{day8}", "html": "{two}"}]}', "decreto_legge",
        ("1", "article", "1", "{id}", "{day}", "{one}"), ("1", "article", "1", "{id}", "{next}", "{later}"), ("2", "article", "2", "{id}", "{day}", "{two}"))

_sample("pl", '{"title": "{title}", "type": "Rozporządzenie", "ELI": "DU/{id}", "inForce": "NOT_IN_FORCE", "announcementDate": "{day}", "html": "<div class=\'parts\'><div class=\'unit unit_chpt\' data-id=\'chpt_1\'><h3>Rozdział 1</h3><div class=\'unit unit_arti\' data-id=\'arti_1\'><h3>Art. 1.</h3><div class=\'pro-text\'>{one}</div></div><div class=\'unit unit_arti\' data-id=\'arti_2\'><h3>Art. 2.</h3><div class=\'pro-text\'>{two}</div></div></div></div>"}', "rozporzadzenie",
        ("chpt_1", "chapter", "Rozdział 1", "DU/{id}", "{day}", ""), ("arti_1", "article", "Art. 1.", "DU/{id}", "{day}", "{one}"), ("arti_2", "article", "Art. 2.", "DU/{id}", "{day}", "{two}"), status="expired")

_sample("pt", '{"published": {"titulo": "{title}", "emissor": "Governo", "eli": "https://data.dre.pt/eli/dec-lei/{id}/p", "vigencia": "CADUCADO"}, "versions": [{"date": "{day}", "fragments": [{"FragmentoId": "g1", "Tituo": "Artigo 1.º", "Texto": "{one}"}, {"FragmentoId": "g2", "Tituo": "Artigo 2.º", "Texto": "{two}"}]}, {"date": "{next}", "amending": {"legis_id": "L{id}"}, "fragments": [{"FragmentoId": "g1", "Tituo": "Artigo 1.º", "Texto": "{later}"}, {"FragmentoId": "g2", "Tituo": "Artigo 2.º", "Texto": "{two}"}]}]}', "decreto-lei",
        ("g1", "fragment", "Artigo 1.º", "L{id}", "{day}", "{one}"), ("g2", "fragment", "Artigo 2.º", "L{id}", "{day}", "{two}"), ("g1", "fragment", "Artigo 1.º", "L{id}", "{next}", "{later}"), status="expired")

_sample("se", '{"dokumentstatus": {"dokument": {"beteckning": "{id}", "titel": "Förordning {title}", "organ": "Regeringen", "datum": "{day}", "html": "<h3>1 kap. Inledning</h3><a class=\'paragraf\' name=\'K1P1\'><b>1 §</b></a><p>{one}</p><a class=\'paragraf\' name=\'K1P2\'><b>2 §</b></a><p>{two}</p>"}}}', "forordning",
        ("chapter-1", "chapter", "1 kap. Inledning", "{id}", "{day}", ""), ("K1P1", "section", "1 §", "{id}", "{day}", "{one}"), ("K1P2", "section", "2 §", "{id}", "{day}", "{two}"))

_SLOVLEX = "<div class='predpis Skupina'><div class='hlavaNadpis'>Prvá hlava</div><div class='paragraf Skupina' id='p-1'><div class='paragrafOznacenie'>§ 1</div><div class='text'>%s</div></div><div class='paragraf Skupina' id='p-2'><div class='paragrafOznacenie'>§ 2</div><div class='text'>{two}</div></div></div>"
_sample("sk", '{"docs": [{"nazov": "{title}", "typPredp": "NariadenieVlady", "ucinnyDo": "{next}"}], "versions": [{"date": "{day}", "amendment": "original", "html": "' + _SLOVLEX % "{one}" + '"}, {"date": "{next}", "amendment": "{id}/1", "html": "' + _SLOVLEX % "{later}" + '"}]}', "government_regulation",
        ("title-1", "title", "Prvá hlava", "original", "{day}", ""), ("p-1", "article", "§ 1", "original", "{day}", "{one}"), ("p-2", "article", "§ 2", "original", "{day}", "{two}"), ("p-1", "article", "§ 1", "{id}/1", "{next}", "{later}"), status="repealed")

_sample("ua", '{"card": {"nazva": "{title}", "types": "Указ, Закон", "stan": "Втратив чинність"}, "eds": [{"datred": {day8}, "pidstava": "o-{id}", "txt": "Розділ I\\nСтаття 1. Перша\\n{one}\\n{із змінами}\\nСтаття 2. Друга\\n{two}"}, {"datred": {next8}, "pidstava": "n-{id}", "txt": "Розділ I\\nСтаття 1. Перша\\n{later}\\nСтаття 2. Друга\\n{two}"}]}', "ukaz",
        ("I", "chapter", "Розділ I", "o-{id}", "{day}", ""), ("1", "article", "Стаття 1. Перша", "o-{id}", "{day}", "{one}"), ("2", "article", "Стаття 2. Друга", "o-{id}", "{day}", "{two}"), ("1", "article", "Стаття 1. Перша", "n-{id}", "{next}", "{later}"), status="repealed")

_sample("uy", '{"tipoNorma": "Decreto Ley", "nroNorma": "{id}", "nombreNorma": "{title}", "fechaPublicacion": "{dayslash}", "articulos": [{"nroArticulo": "1", "tituloArticulo": "Objeto", "textoArticulo": "{one}"}, {"nroArticulo": "2", "textoArticulo": "{two}"}]}', "decreto_ley",
        ("1", "article", "Objeto", "{id}", "{day}", "{one}"), ("2", "article", "2", "{id}", "{day}", "{two}"))

_sample("ad", """<html><head><meta name="organisme" content="Legislació delegada"></head><body><div id="_idContainer000"><p class="Titol-3">{title}</p><p class="Titol-5">Capítol primer</p><p class="Titol-6">Article 1</p><p class="Body-text">{one}</p><p class="Body-text-i">{later}</p><p class="Titol-6">Article 2</p><p class="Body-text">{two}</p><p class="Data">{daydot}</p></div></body></html>""", "decret_llei",
        ("chapter-1", "chapter", "Capítol primer", None, "{day}", ""), ("article-1", "article", "Article 1", None, "{day}", "{one}\n\n{later}"), ("article-2", "article", "Article 2", None, "{day}", "{two}"))

_sample("ar", """<html><body><h2>Resolución {id}</h2><h1>{title}</h1><span class="vr_azul11">{dayslash}</span><a name="1">TITULO I</a><p><b>ARTICULO 1° - </b>{one}</p><p>{later}</p><p><b>Art. 2° - </b>{two}</p></body></html>""", "resolucion",
        ("heading-1", "heading", "TITULO I", None, "{day}", ""), ("1", "article", "ARTICULO 1°", None, "{day}", "{one}\n\n{later}"), ("2", "article", "Art. 2°", None, "{day}", "{two}"))

_sample("gr", '{"search": {"fekId": "{id}", "title": "{title}", "publicationDate": "{daymdy} 00:00:00"}, "tags": [{"topic": "Νόμοι"}], "text": "ΚΕΦΑΛΑΙΟ Α\\nΆρθρο 1 Σκοπός\\n{one}\\nΆρθρο 2 Ορισμοί\\n{two}"}', "nomos",
        ("Α", "chapter", "ΚΕΦΑΛΑΙΟ Α", "{id}", "{day}", ""), ("1", "article", "Άρθρο 1 Σκοπός", "{id}", "{day}", "{one}"), ("2", "article", "Άρθρο 2 Ορισμοί", "{id}", "{day}", "{two}"))
