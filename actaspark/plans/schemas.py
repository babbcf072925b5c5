"""Schemas of the data model; production reads never infer."""

from __future__ import annotations

PUBLICATION_LINK = "url string, numac string, date_doc string, lang string, keyword string, title string, subtitle string"
PUBLICATION_PAGE = "url string, html string"
ENTERPRISE = "EnterpriseNumber string, TypeOfEnterprise string"
DENOMINATION = "EntityNumber string, TypeOfDenomination string, Language string, Denomination string"
ADDRESS = "EntityNumber string, TypeOfAddress string, CountryNL string, CountryFR string, Zipcode string, MunicipalityNL string, MunicipalityFR string, StreetNL string, StreetFR string, HouseNumber string, Box string, ExtraAddressInfo string"
ESTABLISHMENT = "EnterpriseNumber string, EstablishmentNumber string"
REGISTRY_LOOKUP = "bce string, nom string, adresse string, source string"
WATCH = "watch_id long, user string, type string, keyword string, decision_type string, date_from date, rue string, last_scan timestamp, recurrence string, recurrence_weekday string, recurrence_day_of_month int"
WATCH_COMPANY = "watch_id long, numero_tva string"
WATCH_EVENT = "watch_id long, numero_tva string, type string, date_publication date, source string, rubrique string, titre string, tva_list array<string>"
ANNEX_EVENT = "societe string, rubrique string, url string, date_publication date"
DECISION = """id string, date_doc date, lang string, text string, url string, keyword string, TVA array<string>, title string, subtitle string,
extra_keyword array<string>, date_jugement struct<date:string,source:string,confidence:double>,
administrateur array<struct<role:string,entity:string,raw:string>>,
denoms_by_bce array<struct<pos:int,bce:string,type:string,noms:array<string>>>, adresses_by_bce array<struct<pos:int,bce:string,adresses:array<struct<address:string,source:string>>>>"""
