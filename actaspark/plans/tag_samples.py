"""A short text for each tag of the rule packs: what its patterns ask for and little else."""

SAMPLES = {
    "enterprise": {
        "annulation_jugement_tribunal_de_l_entreprise": "mis à néant le jugement",
        "annulation_decision_ag_tribunal_de_l_entreprise": "decide lannulation de la décision de lassemblée generale",
        "designation_liquidateur_remplacement_tribunal_de_l_entreprise": "a été designen remplacement de x,en qualite de liquidateur",
        "designation_liquidateur_tribunal_de_l_entreprise": "nomm liquidateur",
        "rapporte_faillite_tribunal_de_l_entreprise": "est rapportée",
        "rapporte_dissolution_tribunal_de_l_entreprise": "rapport la dissolution",
        "designation_tribunal_de_l_entreprise": "désignation",
        "cloture_insuffisance_actif_tribunal_de_l_entreprise": "cloture insuffisance dactif",
        "cloture_dissolution_tribunal_de_l_entreprise": "clôture de la dissolution judiciaire",
        "cloture_faillite_tribunal_de_l_entreprise": "Clôture faillite",
        "cloture_liquidation_tribunal_de_l_entreprise": "cloture liquidation",
        "dissolution_judiciaire_tribunal_de_l_entreprise": "dissolution judiciaire",
        "ouverture_dissolution_judiciaire_tribunal_de_l_entreprise": "ouverture de la dissolution judiciaire",
        "ouverture_liquidation_judiciaire_tribunal_de_l_entreprise": "ouverture de la procédure de liquidation judiciaire",
        "designation_mandataire_tribunal_de_l_entreprise": "en application de lartXX23",
        "liquidation_tribunal_de_l_entreprise": "liquidationde",
        "delai_modere_tribunal_de_l_entreprise": "délai modéréarticle 5201",
        "ouverture_faillite_tribunal_de_l_entreprise": "ouverture de la faillite",
        "ouverture_transfert_autorite_judiciaire_tribunal_de_l_entreprise": "ouverture du transfert sous autorite judiciaire",
        "transfert_autorite_judiciaire_tribunal_de_l_entreprise": "transfert sous autorite judiciaire",
        "interdiction_gestion_tribunal_de_l_entreprise": "interdiction Aï AÀ",
        "effacement_refusé_tribunal_de_l_entreprise": "effacement refus",
        "sans_effacement_tribunal_de_l_entreprise": "sans effacement de la faillite de",
        "effacement_partiel_tribunal_de_l_entreprise": "éffacement partiel",
        "effacement_tribunal_de_l_entreprise": "effacement accordé",
        "remplacement_juge_commissaire_tribunal_de_l_entreprise": "est remplac par le juge commissaire",
        "remplacement_administrateur_tribunal_de_l_entreprise": "curateurremplac par",
        "prolongation_administrateur_tribunal_de_l_entreprise": "prolong le mandat administrateur provisoire",
        "designation_administrateur_provisoire_tribunal_de_l_entreprise": "désign en qualite dadministrateur provisoire",
        "decharge_administrateur_provisoire_tribunal_de_l_entreprise": "decharge administrateur provisoire",
        "report_cessation_paiement_tribunal_de_l_entreprise": "reportcessation des paiements",
        "ouverture_reorganisation_tribunal_de_l_entreprise": "ouverture de la réorganisation judiciaire",
        "prorogation_reorganisation_tribunal_de_l_entreprise": "prorogation du sursis de la réorganisation judiciaire",
        "nouveau_plan_reorganisation_tribunal_de_l_entreprise": "autorisation de dépôt d'un nouveau plan de la réorganisation judiciaire",
        "homologation_plan_tribunal_de_l_entreprise": "homologation du plan de",
        "homologation_accord_amiable_tribunal_de_l_entreprise": "homologation de l’accord amiable de",
        "revocation_plan_reorganisation_judicaire_tribunal_de_l_entreprise": "révocation du plan de réorganisation judiciaire",
        "refus_hologation_revocation_plan_reorganisation_judicaire_tribunal_de_l_entreprise": "refus d'homologation du planclotur procedure de reorganisation judiciaire",
        "reorganisation_tribunal_de_l_entreprise": "réorganisation judiciaire de",
        "reorganisation_judiciaire_par_accord_collectif_tribunal_de_l_entreprise": "réorganisation judiciaire par accord collectif",
        "designation_administrateur_provisoire_droit_commun_tribunal_de_l_entreprise": "désign en qualité dadministrateur provisoire de droit commun",
        "suspension_effets_ag": "suspend les effet à égard des tiers de la publicationprocesverbaux de assemblée genérale",
        "excusable_tribunal_de_l_entreprise": "le failli est déclaré excusable",
    },
    "first_instance": {
        "appel": "requête dappel",
        "reforme_mise_a_neant": "réforme et met à néant la décision",
        "reforme_ordonnance": "réforme lordonnance",
        "reforme_jugement": "reforme ce jugement",
        "levee_mesure": "levee de la mesure",
        "mise_a_neant": "met à néant la décision",
        "fin de mission": "decharg de la mission d'curateur",
        "fin_mesure": "art 3 c.civ",
        "levee_mesure_observation": "lève la mesure dobservation",
        "cloture_liquidation": "clôture de liquidation",
        "condamnation": "condamn",
        "désignation": "désigné curateur",
        "dissolution_judiciaire": "dissolution judiciaire",
        "rejet_demande": "dit non fondee la demande visant à mettre fin",
        "reforme_decision_jp": "reforme décision la juge de paix",
        "nommination_administrateur": "a été nomm en qualité d'administrateur provisoire",
        "annulation_decision_AG": "decidé lannulation de la decision de lassemblée genérale",
        "délai de contact {n}": "toute personne concernéeest prié dedans le 3 mois",
    },
    "appeal": {
        "succession": "succession",
        "succession_vacante": "successionvacante",
        "succession_deshérence": "successionen désherence",
        "presume_absent": "présum absent",
        "presomption_absence": "présomption dabsence",
        "reforme_mise_a_neant": "réforme et met à néant la decision",
        "rapporte_faillite": "rapport la faillite",
        "reforme_ordonnance": "réforme lordonnance",
        "levee_mesure": "levee de la mesure",
        "mise_a_neant": "met à néant la decision",
        "fin de mission": "decharg de sa mission d’curateur",
        "fin_mesure": "art 3 c.civ",
        "levee_mesure_observation": "leve la mesure dobservation",
        "cloture_liquidation": "cloture de liquidation",
        "effacement_dette": "octroie le benéfice de leffacement",
        "refus_effacement_dette": "refuse d’accorder le benéfice de leffacement",
        "cloture_reorganisation_judiciaire": "clôture la procédure de réorganisation judiciaire",
        "opposition_appel_non_avenue": "dit l'opposition non avenue et ordonne la publication au moniteur belge",
        "est capable": "madame est capable",
        "condamnation": "condamn",
        "sans_domicile_connu": "sans domicile ni domicile",
        "désignation": "désigné curateur",
        "dissolution_judiciaire": "dissolution judiciaire",
        "regime_representation": "sous un régime de représentation par ordonnance",
        "absent": "labsence de Âa",
        "rétractation dissolution": "la dissolution dea été rétracte",
        "homologation_plan_apres_reforme": "reforme le jugement homologué le plan de réorganisation",
        "interdiction_exploiter": "interdisant à Jean Exemple d'exploiter une entreprise",
        "mise_neant_jugement": "la cour dappel de a a mis à néant le jugement",
        "rapporte_revocation_plan_reorganisation": "rapporte la révocation du plan de reorganisation",
        "sursis": "un sursis de six mois est accordé à la société",
        "non_excusable": "est inexcusable",
        "excusable": "est excusable",
        "convention_transfert": "conclusion de la convention de transfert",
        "sursis_accordé_{n}_mois": "un sursis de six mois est accordé à la société",
        "interdiction": "maintient linterdictionde pendant un an",
        "interdiction_{n}_ans": "maintient linterdictionà pendant six an",
        "interdiction_diriger_personne_morale": "interdit à pendant une an prononce linterdiction , pendant cinq an interdisant à pendant sept année d'exercer une fonction conferant le pouvoir d'engager une personne morale",
        "prolongation_sursis": "proroge le sursis jusquau 3.3.33",
    },
    "strike_off": {
        "retrait_radiation_non_depot_comptes": "liste des entite enregistréeretrait de la radiation dofficepour nondepotcomptes annuels",
        "arret_ou_annulation_radiation_adresse_siege": "liste des entite enregistréearret de la radiation doffice siège",
        "annulation_ou_retrait_radiation_ubo": "liste des entité enregistréearrêt radiationofficeubo",
        "retrait_ou_annulation_radiation_office": "liste des entité enregistreearrêt radiationoffice",
        "liste_radiations_adresse_siege": "liste des entité enregistréesuccursaleradié",
        "radiation_office_ubo": "liste des entité enregistréefaisant lobjetradiation dofficeubo",
        "annulation_doublon": "pour cause de doublona été anulée",
        "annulation_remplacement_numero_doublon": "liste des entites enregistréesremplacement du numero d’entreprisepour cause de doublona été anulé",
        "remplacement_numero_bce": "remplac numéro d’entreprise",
        "radiation_office_effectuee": "la radiation doffice des entité suivantesa été effectuee",
        "radiation_adresse_siege": "entite enregistréeadresse du siegea été radiée",
        "annulation_ou_arret_radiation_adresse_siege": "Liste des entités enregistrées, annulation de la radiation d'office quant à l'adresse du siège",
        "annulation_ou_arret_radiation_succursale_siege": "Liste des entités enregistrées, retrait de la radiation d'office quant à l'adresse de la succursale",
        "retrait_radiation_ubo": "arrêt de la radiationofficenonrespectformaliteubo",
        "correction_date_radiation_adresse_siege_ou_succursale": "liste des entites enregistréescorrection de la dateprise deffetadiationofficeadresse du siège",
    },
}
