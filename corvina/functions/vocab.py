"""Vocabularies and patterns of the domain. Operators take them as defaults of parameters."""

# Features, with their identifiers and aliases.
IBSI_FEATURES = (
    ("glcm_entropy", "IBSI:GLCM_ENTROPY", ("glcm entropy", "haralick entropy", "co occurrence entropy", "co-occurrence entropy")),
    ("glcm_contrast", "IBSI:GLCM_CONTRAST", ("glcm contrast", "haralick contrast", "texture contrast")),
    ("glcm_homogeneity", "IBSI:GLCM_HOMOGENEITY", ("glcm homogeneity", "inverse difference moment", "homogeneity")),
    ("first_order_mean", "IBSI:FIRSTORDER_MEAN", ("mean intensity", "first order mean", "average intensity", "mean")),
    ("first_order_skewness", "IBSI:FIRSTORDER_SKEWNESS", ("skewness", "intensity skewness", "first order skewness")),
    ("first_order_kurtosis", "IBSI:FIRSTORDER_KURTOSIS", ("kurtosis", "intensity kurtosis", "first order kurtosis")),
    ("shape_sphericity", "IBSI:SHAPE_SPHERICITY", ("sphericity", "shape sphericity")),
)
BODYCOMP_FEATURES = (
    ("skeletal_muscle_index", "BODYCOMP:SKELETAL_MUSCLE_INDEX", ("skeletal muscle index", "smi")),
    ("visceral_adipose_tissue", "BODYCOMP:VISCERAL_ADIPOSE_TISSUE", ("visceral adipose tissue", "visceral adiposity", "vat")),
    ("subcutaneous_adipose_tissue", "BODYCOMP:SUBCUTANEOUS_ADIPOSE_TISSUE", ("subcutaneous adipose tissue", "sat")),
    ("myosteatosis", "BODYCOMP:MYOSTEATOSIS", ("myosteatosis",)),
    ("muscle_attenuation", "BODYCOMP:MUSCLE_ATTENUATION", ("muscle attenuation",)),
    ("psoas_area", "BODYCOMP:PSOAS_AREA", ("psoas area", "psoas muscle area")),
    ("liver_surface_nodularity", "BODYCOMP:LIVER_SURFACE_NODULARITY", ("liver surface nodularity",)),
    ("sarcopenia", "BODYCOMP:SARCOPENIA", ("sarcopenia",)),
)
#: alias -> (canonical, identifier, family, node type)
ALIASES = {
    alias: (canonical, identifier, family, node)
    for features, family, node in ((IBSI_FEATURES, "radiomic", "RadiomicFeature"), (BODYCOMP_FEATURES, "body_composition", "BodyCompositionFeature"))
    for canonical, identifier, aliases in features
    for alias in aliases
}
BODYCOMP_CANONICAL = tuple(f[0] for f in BODYCOMP_FEATURES)
RADIOMIC_CANONICAL = tuple(f[0] for f in IBSI_FEATURES)
FEATURE_NODE_TYPES = ("RadiomicFeature", "BodyCompositionFeature")
AMBIGUOUS_ALIASES = ("mean", "entropy", "contrast", "homogeneity", "inhomogeneity", "skewness", "kurtosis", "sphericity")
MEAN_NOT = r"\bmean\s+(?:age|follow-?up|survival|years?|months?|days?|hours?)\b"
MEAN_ONLY = (
    r"\b(mean intensity|mean adc|mean attenuation|mean suv|suvmean|mean positive pixel|mean gray|mean grey|histogram mean|"
    r"first[- ]order mean|mean dose|mean signal|mean ct)\b"
)
RADIOMICS_CONTEXT = (
    "radiomics", "radiomic", "texture", "histogram", "first order", "first-order", "glcm", "glrlm", "glszm", "ngtdm", "gray level",
    "voxel", "pixel", "ibsi", "haralick", "feature", "features", "intensity", "attenuation", "adc", "suv",
)
BODYCOMP_CONTEXT = (
    "body composition", "skeletal muscle", "muscle index", "adipose", "adiposity", "myosteatosis", "sarcopenia", "dxa",
    "dual-energy x-ray absorptiometry", "waist", "fat mass", "lean mass", "psoas",
)
#: In the order in which they are tried, as parts of a text.
MODALITIES = (
    ("ct", "CT"), ("computed tomography", "CT"), ("mri", "MRI"), ("magnetic resonance", "MRI"), ("pet", "PET"), ("pet/ct", "PET/CT"),
    ("ultrasound", "US"), ("radiograph", "XRAY"), ("x ray", "XRAY"), ("dxa", "DXA"), ("dexa", "DXA"),
    ("dual-energy x-ray absorptiometry", "DXA"), ("dual energy x-ray absorptiometry", "DXA"), ("absorptiometry", "DXA"),
)
DICOM_CODES = {"CT": "CT", "MRI": "MR", "PET": "PT", "PET/CT": "PT", "US": "US", "XRAY": "DX", "DXA": "DXA"}
BODY_LOCATIONS = (
    "liver", "lung", "pancreas", "kidney", "colon", "rectum", "brain", "prostate", "breast", "spleen", "heart", "aorta", "abdomen",
    "abdominal", "muscle", "muscular", "skeletal", "adipose", "bone", "cerebral", "waist", "lumbar", "vertebral", "spine", "spinal",
    "hip", "trunk", "femur", "femoral", "thigh",
)
SIGNATURES = (
    "dysbiosis", "alpha diversity", "beta diversity", "microbial signature", "microbial signatures", "microbiota composition",
    "gut microbiota composition", "microbial community", "intratumoral microbiome", "microbiome abundance",
)
GENERA = (
    "akkermansia", "bacteroides", "bifidobacterium", "bilophila", "christensenellaceae", "collinsella", "enterococcus", "escherichia",
    "fusobacterium", "helicobacter", "lactobacillus", "parabacteroides", "phascolarctobacterium", "porphyromonadaceae", "prevotella",
    "rikenellaceae", "roseburia", "ruminococcus", "streptococcus",
)
BINOMIAL = r"\b([A-Z][a-z]{2,}\s[a-z][a-z\-]{2,})\b"
MICROBE_STOPWORDS = ("analysis", "cancer", "carcinoma", "disease", "lesion", "model", "response", "syndrome", "therapy", "tumor", "tumour")
DISEASE = (
    r"(?i)\b([a-z][a-z\-]*(?:\s[a-z][a-z\-]*){0,4}\s(?:cancer|carcinoma|tumou?r|disease|syndrome|lesion|fibrosis|diabetes|obesity|"
    r"cirrhosis|adenocarcinoma|inflammation))\b"
)
DISEASE_LEAD_STOPWORDS = (
    "is", "are", "was", "were", "in", "of", "with", "and", "or", "the", "a", "an", "this", "that", "at", "by", "but", "for", "from",
    "among", "against", "through", "during", "without", "between", "according", "depending", "either", "as", "like", "to", "when",
    "particularly", "independent", "indicate", "abstract", "introduction", "aims", "aim", "background", "abbreviations", "discussion",
    "conclusion", "methods", "results", "objectives", "purpose", "summary", "early", "consequently", "subsequently", "regardless",
    "considering", "delays", "determine", "findings", "investigating", "following", "controls", "participants", "people", "samples",
    "subjects", "fold", "basal", "flaxseed", "androgen", "exercise", "dietary", "important", "related", "training", "such", "pepper",
    "including", "affecting", "induced", "associated", "effects", "role", "impact",
)
DISEASE_CONTEXT_STOPWORDS = (
    "humans", "human", "patients", "subjects", "training", "distribution", "degree", "density", "components", "intake", "lessens",
    "reduces", "causes", "affects", "affected", "induced", "diet", "is", "are", "was", "were", "by", "via", "phenotype", "marker",
    "highlight", "highlights", "exposure", "supplementation", "substrate", "pathway", "pathways", "consequently", "regardless",
    "subsequently",
)
#: In order of precedence.
CLAIM_HINTS = (
    ("predictive", ("predict", "predictive", "prediction")),
    ("prognostic", ("prognosis", "prognostic", "survival", "outcome")),
    ("diagnostic", ("diagnosis", "diagnostic", "detect", "detection")),
    ("association", ("associate", "associated", "correlat", "linked", "relationship")),
)
# Cleaning of spans.
SURROUNDING = "\"'`[]{}()"
GENERIC_MICROBES = (
    "bacteria", "bacterias", "bacterial", "bacterial abundance", "bacterial communities", "bacterial community", "bacterial density",
    "bacterial load", "bacterial presence", "bacterial species", "microbe", "microbes", "microbial", "microbial abundance",
    "microbial communities", "microbial community", "microbial density", "microbial load", "microbial presence", "microbiome",
    "microbiota", "organism", "organisms", "probiotic", "probiotics",
)
GENERIC_DISEASES = ("disease", "diseases")
MICROBE_TRAILING = (
    "abundance", "abundances", "bearing", "class", "classes", "count", "counts", "density", "families", "family", "genus", "genera",
    "level", "levels", "load", "loads", "phylum", "phyla", "presence", "taxa", "taxon",
)
DISEASE_TRAILING = (
    "analysis", "case", "cases", "cohort", "cohorts", "control", "controls", "group", "groups", "marker", "markers", "model", "models",
    "patient", "patients", "risk", "risks", "score", "scores", "study", "studies", "subject", "subjects",
)
TRAILING_STOPS = ("a", "an", "the", "this", "these", "those", "in", "of", "among", "within", "during", "across")
SUBJECT_FRAGMENTS = ("and", "or", "but", "is", "are", "was", "were", "be", "been", "being", "with", "as")
RELATION_LANGUAGE = (
    "associated", "association", "abundant", "ameliorate", "ameliorates", "anti-inflammatory", "appears", "cause", "causes",
    "contribute", "contributes", "correlated", "correlation", "decrease", "decreased", "elevated", "enhance", "enhanced", "enhances",
    "higher", "improved", "improvement", "increase", "increased", "increases", "induce", "induces", "link", "linked", "lower",
    "predictive", "prevent", "prevents", "prognostic", "promote", "promotes", "pro-inflammatory", "reduce", "reduced", "reduction",
    "reduces", "related", "relationship", "relationships", "worsened", "worsening",
)
DISEASE_CONTEXT = (
    *DISEASE_TRAILING, "abundance", "density", "feature", "features", "indicator", "indicators", "level", "levels", "manifestation",
    "manifestations", "presence", "signature", "signatures",
)
CLAUSE_PRONOUNS = ("current", "our", "their", "this", "these", "those")
CLAUSE_VERBS = (*SUBJECT_FRAGMENTS, "has", "have", "had", "more", "less")
LEADING_CONTEXT = ("and", "among", "during", "for", "in", "of", "or", "within", "with")
_PEOPLE = "(?:adult|adults|child|children|individual|individuals|patient|patients|people|participant|participants|subject|subjects|women|men)"
LEADING_PREFIXES = (
    rf"^(?:in|among|within)\s+{_PEOPLE}\s+with\s+",
    r"^one of the (?:main )?manifestations of\s+",
    r"^(?:main )?manifestations of\s+",
    rf"^of\s+.+?\b(?:in|among|within)\s+{_PEOPLE}\s+with\s+",
)
PRODUCT_SUFFIXES = (
    "probiotic", "probiotics", "supplement", "supplements", "preparation", "preparations", "capsule", "capsules", "formulation",
    "formulations",
)
FINDING_IN_DISEASE = (
    r"^(.+?)\s+in\s+((?:cirrhosis|obesity|diabetes|cancer|fibrosis|hepatitis|colitis|crohn|asthma|copd|nafld|mafld|nash|ckd|hiv infection|"
    r"chronic kidney disease|inflammatory bowel disease|colorectal cancer|liver disease|heart failure|cardiovascular disease|"
    r"metabolic syndrome|rheumatoid arthritis|celiac disease|type 2 diabetes|chronic liver disease|nonalcoholic fatty liver disease).*)$"
)
# Which diseases may stand in the graph.
DISEASE_REJECT = (
    "s disease", "all disease", "number of disease", "identifying disease", "any disease", "multidimensional syndrome", "disease", "cancer",
)
DISEASE_NORMALIZED = (r"^presence of\s+", r"^biopsy-proven\s+")
DISEASE_ALIASES = {"mafld metabolic dysfunction-associated fatty liver disease": "metabolic dysfunction-associated fatty liver disease"}
DISEASE_REJECT_PREFIXES = (
    r"(?:is|are|was|were)\b", r"(?:suggesting|revealed|triggering)\b", r"such as\b", r"as a measure of\b", r"a specific measure of\b",
    r"evidence for\b", r"time points of\b", r"may\b", r"thus\b", r"induced through\b", r"modulation of\b", r"rather than\b",
    r"(?:the )?(?:development|treatment|mechanism)\b", r"guidelines?\b", r"the gut microbiota\b", r"gut microbi(?:ota|ome)\b",
    r"normal muscle mass\b", r"dietary fiber intake\b", r"vicious circle\b", r"offering\b", r"dependent\b", r"preventing\b", r"since\b",
    r"because\b", r"despite\b", r"including\b", r"hallmark of\b", r"models? of\b", r"improve\b", r"individuals? with\b",
    r"patients? with\b", r"subjects? with\b", r"controls? with(?:out)?\b", r"participants? with(?:out)?\b", r"people with(?:out)?\b",
    r"samples? of\b", r"from (?:individuals?|various|people)\b", r"mediated\b", r"grade\b", r"[a-z]+-driven\b",
    r"(?:abstract|introduction|aims?|background|abbreviations?|discussion|conclusion|objectives?|purpose|summary)\b",
    r"(?:according to|between|from|at the|depending|but|either|among|against|as a|like|when|particularly in|to (?:compare|the onset|protect))\b",
    r"(?:consequently|subsequently|regardless|delays?|determine|findings?|investigating|early life|fold change|basal metabolic|"
    r"androgen deprivation|flaxseed|biological substrate|cell division|amino acid ibd)\b",
    r"mechanisms? of\b", r"independent of\b", r"known as\b", r"indicate\b", r"individual susceptibility\b", r"influences? the\b",
    r"roles?\b", r"most prevalent\b", r"multiple testing\b", r"macrophage\b", r"pan-", r"picrosirius\b", r"short-chain\b",
    r"mm mercury\b", r"succinate background\b", r"tissue to\b", r"protection against\b", r"all disease\b", r"number of disease\b",
    r"identifying disease\b", r"organ dysfunction\b", r"(?:f|na)\s",
)
DISEASE_REJECT_PARTS = (
    r"\bcauses?\b", r"\bis a disease\b", r"\bwithout affecting\b", r"\bcontrolling\b", r"\blessens?\b", r"\baffect(?:s|ing)?\b",
    r"\binfluenc(?:e|ed)\b", r"\bpromotes?\b", r"\binduces?\b", r"\bameliorates?\b", r"\bcontributes?\b", r"\bprevents?\b",
    r"\bmitigates?\b", r"\bin patients? without\b", r"\bsupplementation\b", r"\bhighlights?\b", r"\bpathways?\b", r"\bexposure\b",
    r"\bsubstrate\b", r"\btrigger\b", r"\bintervention\b", r"\bvisualize\b", r"\bstain\b", r"\bbackground\b",
)
DISEASE_CONTEXT_REJECT = ("development", "treatment", "mechanism", "guideline", "guidelines", "microbiota", "muscle", "intake", "circle", "intrinsic")
KEPT_INFLAMMATIONS = ("low-grade chronic inflammation", "systemic inflammation")
LEAKED_PHENOTYPES = (
    *(c.replace("_", " ") for c in (*BODYCOMP_CANONICAL, *RADIOMIC_CANONICAL)), "gut bacteria", "gut microbiome", "gut microbiota", "marrow adiposity",
)
# Relation labels and their markers, captions, graph.
REL_BY_LABEL = {"positive": "POSITIVELY_CORRELATED_WITH", "negative": "NEGATIVELY_CORRELATED_WITH"}
CAPTION_POSITIVE = (
    r"correlation\s+matrix", r"correlation\s+heatmap", r"\bspearman'?s?\b", r"\bpearson'?s?\b", r"\brho\b\s*=", r"ρ\s*=", r"\br\s*=",
    r"\br\s*-?\s*value", r"\bcorrelation\s+coefficient", r"\bcorrelogram\b",
)
CAPTION_NEGATIVE = (
    r"log\s*fold\s*change", r"\blfc\b", r"log\s*2\s*fold", r"\blog2fc\b", r"\bz\s*-?\s*score", r"\bp\s*-?\s*value\s+matrix",
    r"differential\s+(abundance|expression)",
)
WRITE_CLAUSES = ("CREATE", "MERGE", "DELETE", "SET ", "REMOVE", "DROP", "DETACH", "CALL {", "LOAD CSV", "FOREACH")
RELATION_TYPES = {
    "ASSOCIATED_WITH": "TEXT_ASSOCIATION",
    "CORRELATES_WITH": "VISION_OR_TEXT_CORRELATION",
    "POSITIVELY_CORRELATED_WITH": "MICROBE_DISEASE_POS",
    "NEGATIVELY_CORRELATED_WITH": "MICROBE_DISEASE_NEG",
    "MEASURED_AT": "BACKBONE_LOCATION",
    "ACQUIRED_VIA": "BACKBONE_MODALITY",
    "REPRESENTED_BY": "BACKBONE_IMAGE",
}
EVIDENCE_TYPES = {
    "ASSOCIATED_WITH": "text_rule_verified",
    "CORRELATES_WITH": "quantitatively_verified",
    "POSITIVELY_CORRELATED_WITH": "text_signed_co_mention",
    "NEGATIVELY_CORRELATED_WITH": "text_signed_co_mention",
    "MEASURED_AT": "schema_backbone",
    "ACQUIRED_VIA": "schema_backbone",
    "REPRESENTED_BY": "schema_backbone",
}
RELATIONSHIP_COLUMNS = (
    "source_node_type", "source_node", "target_node_type", "target_node", "rel_type", "pmid", "pmcid", "journal", "title",
    "publication_year", "impact_factor", "quartile", "issn", "evidence", "confidence", "verification_passed", "positive_support",
    "negative_support", "net_confidence", "supporting_pmids",
)
POSITIVE_MARKERS = ("increase", "increased", "higher", "enriched", "associated with", "promotes", "elevated", "risk", "correlated", "positive")
NEGATIVE_MARKERS = ("decrease", "decreased", "lower", "reduced", "protective", "ameliorate", "inhibits", "negative", "inversely")
TOPOLOGY_KEYWORDS = {
    "heatmap": ("heatmap", "heat map", "correlation matrix", "cluster map", "clustermap", "color map", "matrix"),
    "scatter_plot": ("scatter plot", "scatter", "scatterplot", "correlation scatter", "pearson correlation", "spearman correlation"),
    "dot_plot": ("dot plot", "dotplot", "lollipop", "bubble plot"),
    "forest_plot": ("forest plot", "hazard ratio", "odds ratio", "confidence interval", "meta-analysis", "meta analysis", "ci"),
}
TOPOLOGY_WEIGHTS = {"heatmap": 0.2, "scatter_plot": 0.25, "dot_plot": 0.25, "forest_plot": 0.2}
# Which words make a microbe.
NOT_MICROBE_FIRST = (
    "a", "an", "the", "this", "that", "these", "those", "in", "on", "of", "for", "to", "from", "with", "without", "at", "by", "we", "our",
    "their", "its", "study", "analysis", "prediction", "development", "evaluation", "assessment", "patients", "model", "models", "radiomics",
)
MICROBE_PARTS = (
    "bacter", "coccus", "bacillus", "bacteria", "bacterium", "microbe", "staphyl", "strept", "lactobac", "bifido", "escherich", "clostrid",
    "fusobacter", "ruminococcus",
)
COMMON_GENERA = (
    "escherichia", "fusobacterium", "clostridium", "bacteroides", "prevotella", "streptococcus", "staphylococcus", "lactobacillus",
    "bifidobacterium", "ruminococcus", "akkermansia", "faecalibacterium", "enterococcus", "anaerostipes", "blautia", "alistipes",
    "roseburia", "parabacteroides", "desulfovibrio", "coprococcus",
)
# Types and concepts that the entity gates accept or deny.
GROUNDING_FLOOR = 0.85
MICROBE_TUIS = ("T005", "T007", "T194", "T204")
DISEASE_TUIS = ("T047", "T191", "T048", "T046", "T019")
FEATURE_TUIS = ("T201", "T033", "T034", "T184")
TAGGER_DISEASE_TUIS = ("T019", "T020", "T033", "T037", "T046", "T047", "T048", "T049", "T184", "T190", "T191")
TAGGER_MICROBE_TUIS = ("T007",)
DENIED_CUIS = {
    "C0086418": "Homo sapiens", "C0025929": "Mus musculus", "C0034693": "Rattus norvegicus", "C0010076": "Cells (generic)",
    "C0007634": "Cells (generic)", "C0021359": "Infant", "C0030705": "Patients", "C0683329": "Donors",
}
#: Provenance tags of entities by parts of a model's name, in the order in which they are tried.
EXTRACTOR_TAGS = {"openmed_speciesdetect": ("speciesdetect", "openmed-ner-species"), "distilbert_biomedical": ("biomedical-ner-all", "d4data")}
# Captions of figures that may be read.
QUALIFYING_CAPTIONS = (
    "heatmap", "heat map", "correlation matrix", "cluster map", "clustermap", "spearman", "pearson", "colormap", "color map", "forest plot",
    "hazard ratio", "odds ratio", "confidence interval", "meta-analysis", "scatter", "correlation scatter", "dot plot", "lollipop", "bubble plot",
)
HEATMAP_CAPTIONS = (
    "heatmap", "heat map", "correlation matrix", "cluster map", "clustermap", "spearman", "pearson", "colormap", "color map", "correlation heatmap",
)
# Concepts that sentences are retrieved for, with their synonyms.
CONCEPT_THRESHOLD = 0.62
CONCEPTS = {
    "sarcopenia": ("sarcopenic", "muscle wasting", "low skeletal muscle", "muscle depletion", "age-related muscle loss"),
    "skeletal_muscle_index": ("SMI", "skeletal muscle index", "L3 muscle area", "cross-sectional muscle area at L3", "lumbar muscle area"),
    "visceral_adipose_tissue": ("VAT", "visceral adipose tissue", "visceral adiposity", "visceral fat", "intra-abdominal fat"),
    "subcutaneous_adipose_tissue": ("SAT", "subcutaneous adipose tissue", "subcutaneous fat", "abdominal subcutaneous fat"),
    "myosteatosis": ("muscle fat infiltration", "intramuscular fat", "low muscle attenuation", "fatty infiltration of muscle"),
    "body_fat": ("fat mass", "total body fat", "body fat percentage", "adiposity"),
    "bone_mineral_density": ("BMD", "bone mineral density", "DXA bone density", "T-score"),
    "hepatic_steatosis": ("liver fat", "fatty liver", "liver attenuation", "PDFF", "proton density fat fraction"),
    "muscle_attenuation": ("muscle radiation attenuation", "muscle Hounsfield units", "MRA"),
}
# The gold set.
ASSOCIATED_LABELS = ("associated_positive", "associated_negative", "associated_unsigned")
NOT_ASSOCIATED_LABELS = ("no_association_explicit", "not_associated")
GOLD_TARGETS = {"accepted_edge": 15, "gemini_rejected": 50, "vocab_excluded": 35, "recall_probe": 30, "random_co_occurrence": 20}
EXTENDED_KEYWORDS = {
    "psoas": "psoas_muscle_area", "psoas muscle": "psoas_muscle_area", "pmi": "psoas_muscle_index",
    "intermuscular adipose": "intermuscular_adipose_tissue", "imat": "intermuscular_adipose_tissue",
    "epicardial adipose": "epicardial_adipose_tissue", "epicardial fat": "epicardial_adipose_tissue", "eat": "epicardial_adipose_tissue",
    "pericardial fat": "pericardial_adipose_tissue", "pericardial adipose": "pericardial_adipose_tissue", "liver fat": "hepatic_steatosis",
    "hepatic fat": "hepatic_steatosis", "pdff": "hepatic_steatosis", "proton density fat fraction": "hepatic_steatosis",
    "pancreatic fat": "pancreatic_steatosis", "pancreatic steatosis": "pancreatic_steatosis", "bone marrow fat": "bone_marrow_adiposity",
    "bone marrow adiposity": "bone_marrow_adiposity", "t-score": "bone_mineral_density", "z-score": "bone_mineral_density",
    "cachexia": "cachexia", "frailty": "frailty", "asmm": "appendicular_skeletal_muscle_mass",
    "appendicular skeletal muscle": "appendicular_skeletal_muscle_mass", "ffmi": "fat_free_mass_index",
    "fat-free mass index": "fat_free_mass_index", "cross-sectional area": "muscle_cross_sectional_area",
    "csa at l3": "muscle_cross_sectional_area", "l3 muscle area": "muscle_cross_sectional_area", "myostatin": "myostatin_level",
    "fractal dimension": "glcm_fractal_dimension", "glcm": "glcm_texture_feature", "wavelet": "wavelet_texture_feature",
}
WHOLE_KEYWORDS = ("pmi", "imat", "eat", "pdff", "asmm", "ffmi", "glcm")
BODY_TOKENS = ("muscle", "fat", "bone", "liver", "adipose", "skeletal", "lean", "obesity", "weight")
BODY_ABBREVIATIONS = ("bmi", "ct", "mri", "dxa")
# Prompts, in words of our own, and the forms in which families of models take them.
RELATION_ROLE = "You read excerpts of research papers and say which relation they tell between a microbe and a disease. Say only what the excerpt says."
RELATION_LABELS = (
    "Answer with one label.\npositive: the microbe causes or aggravates the disease, or increases with it.\n"
    "negative: the microbe helps against the disease, or decreases with it.\nna: the excerpt tells neither of them."
)
RELATION_EVIDENCE = "Excerpt:\n%s\n\nWhat is the relation between %s and %s?\n"
CHAT_FORMS = {
    ("mistral", "mixtral", "biomistral"): "<s>[INST] %s\n%s [/INST]",
    ("zephyr",): "<|system|>\n%s</s>\n<|user|>\n%s</s>\n<|assistant|>\n",
    ("llama",): "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n%s<|eot_id|><|start_header_id|>user<|end_header_id|>\n%s<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n",
}
PLAIN_FORM = "System: %s\nUser: %s\nAssistant:"
VERIFIER_QUESTION = (
    "Figure type: %s\nRow: %s\nColumn: %s\nValue: %s, of a range from %s to %s\n"
    'Does the colour of the cell (row "%s", column "%s") agree with the value, by the colour bar? Answer "inconclusive" if the cell can\'t be seen.\n'
    'One JSON object: {"verdict": "pass", "fail" or "inconclusive", "observed_color_band": text, "discrepancy": "none", "small" or "large", "confidence": 0 to 1}'
)
# Blocks of search terms; * stands for any ending.
SEARCH_BLOCKS = {
    "radiomics": (
        "radiomics", "radiomic*", "texture analysis", "texture feature*", "glcm", "glrlm", "glszm", "ngtdm", "gldm", "first-order feature*",
        "shape feature*", "wavelet feature*", "fractal dimension", "laplacian of gaussian", "LoG", "quantitative imaging feature*",
        "radiogenomics", "deep radiomics", "run length feature*", "histogram feature*", "pyradiomics",
    ),
    "bodycomp": (
        "body composition", "body composition analysis", "skeletal muscle index", "sarcopenia", "liver surface nodularity",
        "visceral adipose tissue", "visceral adiposity", "subcutaneous adipose tissue", "muscle attenuation", "muscle mass", "lean mass",
        "fat mass", "psoas area", "myosteatosis", "bone mineral density", "BMD", "hepatic steatosis", "fat fraction", "PDFF",
        "proton density fat fraction", "intramuscular fat", "liver fat", "trabecular bone score",
    ),
    "modality": ("computed tomography", "CT", "magnetic resonance imaging", "MRI", "PET", "positron emission tomography"),
    "bodycomp_modality": ("computed tomography", "CT", "magnetic resonance imaging", "MRI", "dual-energy x-ray absorptiometry", "DXA"),
    "expanded_modality": (
        "computed tomography", "CT", "magnetic resonance imaging", "MRI", "dual-energy x-ray absorptiometry", "DXA",
        "positron emission tomography", "PET", "ultrasound", "sonography", "sonographic", "ultrasonography", "elastography", "MRE",
        "magnetic resonance elastography", "transient elastography", "FibroScan", "shear wave elastography", "multiparametric MRI", "mpMRI",
        "dual-energy CT", "DECT", "spectral CT",
    ),
    "human": ("human*", "adult*", "patient*", "patients", "cohort", "clinical", "women", "men"),
    "adjacent": (
        "imaging phenotype", "imaging phenotypes", "quantitative imaging", "quantitative CT", "CT change*", "computed tomography change*",
        "airway lesion*", "airway remodeling", "air trapping", "emphysema", "radiographic phenotype*", "imaging feature*", "3D-CT", "3D CT",
    ),
    "microbiome": (
        "microbiome", "microbiota", "gut microbiota", "intratumoral microbiome", "intratumoral microbiota", "dysbiosis", "alpha diversity",
        "beta diversity", "microbiota composition", "microbiome abundance", "microbial signature", "microbial signatures",
        "microbial community", "16S rRNA", "metagenomic*", "metagenome", "gut flora", "bacteriome", "mycobiome", "virome",
        "shotgun metagenomic*", "fecal microbiota transplant*", "microbial diversity",
    ),
    "outcome": ("predict*", "prognosis", "prognostic", "diagnosis", "diagnostic", "biomarker", "survival", "outcome*"),
    "association": ("associat*", "correlat*"),
    "elastography": (
        "liver stiffness", "liver fibrosis", "hepatic steatosis", "PDFF", "proton density fat fraction", "liver surface nodularity", "NAFLD",
        "MAFLD", "MASLD", "cirrhosis", "hepatocellular carcinoma",
    ),
}
NOT_PRIMARY = ("systematic review", "meta-analysis", "protocol", "rationale and design")
#: Profiles: all blocks of one alternative must match; a + joins blocks of which one must; True leaves out what is not primary work.
SEARCH_PROFILES = {
    "microbe_radiomics": ((("radiomics", "modality", "microbiome"), ("bodycomp", "bodycomp_modality", "microbiome"), ("adjacent", "modality", "microbiome")), True),
    "microbe_radiomics_strict": ((("radiomics", "modality", "microbiome"),), True),
    "microbe_imaging_adjacent": ((("adjacent", "modality", "microbiome"),), True),
    "microbe_imaging_phenotype": ((("radiomics", "modality", "microbiome"), ("bodycomp", "bodycomp_modality", "microbiome"), ("adjacent", "modality", "microbiome")), True),
    "microbe_bodycomp": ((("bodycomp", "bodycomp_modality", "microbiome"),), True),
    "microbe_bodycomp_clinical_recall": ((("bodycomp", "microbiome", "association+outcome", "human"),), True),
    "radiomics_disease": ((("radiomics", "modality", "outcome+association"),), False),
    "radiomics_disease_strict": ((("radiomics", "modality", "outcome+association"),), False),
    "bodycomp_disease": ((("bodycomp", "bodycomp_modality", "outcome"),), False),
    "bodycomp_disease_association": ((("bodycomp", "bodycomp_modality", "outcome+association"),), False),
    "microbe_liver_elastography": ((("elastography", "expanded_modality", "microbiome"),), True),
    "microbe_bodycomp_expanded_modality": ((("bodycomp", "expanded_modality", "microbiome"),), True),
}
