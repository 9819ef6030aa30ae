"""Fixed values of the domain: categories, topics, venues, section headings, messages.

Everything here is data that results depend on; none of it is logic.
"""

# Archive categories.
COMPUTING_CATEGORIES = (
    "cs.AI",
    "cs.CL",
    "cs.CV",
    "cs.LG",
    "cs.NE",
    "cs.IR",
    "cs.RO",
    "cs.CR",
    "cs.DS",
    "cs.DB",
    "cs.HC",
    "cs.SE",
    "cs.GT",
    "cs.IT",
    "cs.MA",
    "cs.MM",
    "cs.SI",
    "cs.CC",
    "cs.CG",
    "cs.DC",
    "cs.DM",
    "cs.ET",
    "cs.FL",
    "cs.GR",
    "cs.MS",
    "cs.NA",
    "cs.OH",
    "cs.OS",
    "cs.PF",
    "cs.PL",
    "cs.SC",
    "cs.SY",
    "cs.SD",
)
BIOLOGY_CATEGORIES = (
    "q-bio.BM",
    "q-bio.CB",
    "q-bio.GN",
    "q-bio.MN",
    "q-bio.NC",
    "q-bio.OT",
    "q-bio.PE",
    "q-bio.QM",
    "q-bio.SC",
    "q-bio.TO",
)
CATEGORIES = COMPUTING_CATEGORIES + BIOLOGY_CATEGORIES

# Labels of categories.
CATEGORY_LABELS = {
    "cs.AI": "Artificial Intelligence",
    "cs.CL": "Computation and Language (NLP)",
    "cs.CV": "Computer Vision",
    "cs.LG": "Machine Learning",
    "cs.IR": "Information Retrieval",
    "cs.NE": "Neural and Evolutionary Computing",
    "cs.RO": "Robotics",
    "cs.SD": "Sound",
    "stat.ML": "Machine Learning (Statistics)",
    "math.OC": "Optimization and Control",
    "physics": "Physics",
    "q-bio": "Quantitative Biology",
    "q-fin": "Quantitative Finance",
    "q-bio.BM": "Biomolecules",
    "q-bio.CB": "Cell Behavior",
    "q-bio.GN": "Genomics",
    "q-bio.MN": "Molecular Networks",
    "q-bio.NC": "Neurons and Cognition",
    "q-bio.OT": "Other Quantitative Biology",
    "q-bio.PE": "Populations and Evolution",
    "q-bio.QM": "Quantitative Methods",
    "q-bio.SC": "Subcellular Processes",
    "q-bio.TO": "Tissues and Organs",
}

# Search topics.
COMPUTING_TOPICS = (
    "transformer neural network attention",
    "self-attention multi-head attention mechanism",
    "large language model pretraining scaling",
    "LLM instruction tuning alignment RLHF",
    "chain-of-thought reasoning in-context learning",
    "retrieval augmented generation RAG",
    "mixture of experts MoE transformer",
    "language model quantization pruning efficient",
    "multimodal large language model vision language",
    "LLM agent tool use planning reasoning",
    "vision transformer ViT DeiT Swin",
    "object detection segmentation DETR mask R-CNN",
    "image generation diffusion model stable",
    "neural radiance field NeRF 3D reconstruction",
    "video understanding action recognition transformer",
    "image super-resolution restoration deep learning",
    "contrastive learning self-supervised vision",
    "masked autoencoder MAE pretraining",
    "text summarization abstractive extractive",
    "machine translation neural multilingual",
    "question answering reading comprehension QA",
    "named entity recognition relation extraction",
    "sentiment analysis opinion mining deep",
    "dialogue system conversational chatbot",
    "code generation program synthesis LLM",
    "semantic parsing text-to-SQL knowledge base",
    "speech recognition ASR transformer conformer",
    "deep neural network optimization SGD Adam",
    "batch normalization layer normalization transformer",
    "residual network ResNet DenseNet EfficientNet",
    "generative adversarial network GAN StyleGAN",
    "variational autoencoder VAE normalizing flow",
    "diffusion probabilistic model score-based",
    "neural ordinary differential equation ODE",
    "knowledge distillation model compression teacher student",
    "neural architecture search NAS AutoML",
    "meta-learning few-shot learning MAML",
    "federated learning privacy preserving FL",
    "dropout regularization data augmentation mixup",
    "deep reinforcement learning DQN PPO SAC",
    "multi-agent reinforcement learning MARL",
    "model-based reinforcement learning planning",
    "offline reinforcement learning batch RL",
    "inverse reinforcement learning IRL",
    "graph neural network GNN message passing",
    "graph attention network GAT GraphSAGE",
    "molecular graph drug discovery GNN",
    "knowledge graph embedding reasoning transE",
    "graph contrastive learning self-supervised",
    "collaborative filtering matrix factorization deep",
    "sequential recommendation transformer SASRec",
    "dense retrieval DPR information retrieval",
    "learning to rank neural ranking",
    "distributed training data parallelism model",
    "adversarial attack defense robustness deep learning",
    "differential privacy machine learning",
    "generalization theory deep learning overparameterization",
    "neural tangent kernel infinite width",
    "implicit bias gradient descent",
    "representation learning theory identifiability",
)
BIOLOGY_TOPICS = (
    "genome sequencing assembly deep learning",
    "single-cell RNA sequencing scRNA-seq analysis",
    "CRISPR gene editing computational prediction",
    "epigenomics chromatin accessibility deep learning",
    "gene regulatory network inference GRN",
    "genome-wide association study GWAS machine learning",
    "population genetics deep learning selection",
    "metagenomics microbiome deep learning",
    "structural variant detection long-read sequencing",
    "multi-omics integration machine learning",
    "protein structure prediction AlphaFold deep",
    "protein folding molecular dynamics simulation",
    "protein-protein interaction prediction docking",
    "protein design engineering deep learning",
    "protein function prediction GO annotation",
    "antibody design computational deep learning",
    "enzyme engineering directed evolution machine",
    "drug-target interaction prediction deep",
    "virtual screening molecular docking deep learning",
    "molecular property prediction QSAR deep",
    "de novo drug design generative model",
    "ADMET prediction absorption distribution metabolism",
    "drug repurposing computational systems biology",
    "cheminformatics deep learning representation",
    "neural coding information theory brain",
    "connectome analysis network neuroscience",
    "fMRI functional MRI analysis deep learning",
    "brain-computer interface decoding neural",
    "spiking neural network computational model",
    "neuroimaging segmentation MRI CT deep",
    "metabolic network modeling constraint-based FBA",
    "signaling pathway reconstruction inference",
    "biological network analysis graph theory",
    "systems biology dynamical modeling ODE",
    "synthetic biology circuit design genetic",
    "medical image segmentation deep learning U-Net",
    "pathology image analysis computational digital",
    "electronic health record EHR prediction ML",
    "biomarker discovery machine learning omics",
    "cancer genomics tumor heterogeneity evolution",
    "immunoinformatics epitope prediction T-cell",
    "precision medicine pharmacogenomics personalized",
    "phylogenetics maximum likelihood Bayesian inference",
    "molecular evolution positive selection dN/dS",
    "comparative genomics evolution conservation",
    "epidemiological modeling SIR COVID infectious",
    "sequence alignment algorithm BLAST HMM",
    "RNA-seq differential expression DESeq2 edgeR",
    "Hi-C chromatin 3D genome structure",
    "spatial transcriptomics analysis deep learning",
    "single-cell ATAC-seq multiome integration",
)

# Venues of the first tier.
COMPUTING_VENUES = (
    "NeurIPS",
    "ICML",
    "ICLR",
    "AAAI",
    "IJCAI",
    "CVPR",
    "ICCV",
    "ECCV",
    "ACL",
    "EMNLP",
    "NAACL",
    "KDD",
    "WWW",
    "SIGIR",
    "WSDM",
    "CIKM",
    "OSDI",
    "SOSP",
    "ASPLOS",
    "ISCA",
    "IEEE S&P",
    "CCS",
    "USENIX Security",
    "STOC",
    "FOCS",
    "SODA",
    "COLT",
    "ICRA",
    "IROS",
    "RSS",
    "CoRL",
    "JMLR",
    "TPAMI",
    "TACL",
)
BIOLOGY_VENUES = (
    "Nature",
    "Science",
    "PNAS",
    "Nature Communications",
    "Science Advances",
    "eLife",
    "PLOS Biology",
    "BMC Biology",
    "Nature Biotechnology",
    "Nature Methods",
    "Nature Genetics",
    "Nature Neuroscience",
    "Nature Medicine",
    "Nature Chemical Biology",
    "Cell",
    "Molecular Cell",
    "Developmental Cell",
    "Cancer Cell",
    "Cell Systems",
    "Cell Reports",
    "Genome Biology",
    "Genome Research",
    "Nucleic Acids Research",
    "Bioinformatics",
    "PLOS Computational Biology",
    "Briefings in Bioinformatics",
    "Molecular Systems Biology",
    "Neuron",
    "Journal of Neuroscience",
    "Nature Structural Molecular Biology",
    "GigaScience",
    "Bioinformatics Advances",
)
TOP_VENUES = COMPUTING_VENUES + BIOLOGY_VENUES

# Headings of sections, tried in this order against a stripped line.
SECTION_HEADINGS = (
    ("abstract", (
        r"(?i)^\s*abstract\s*$",
        r"(?i)^\s*a\s*b\s*s\s*t\s*r\s*a\s*c\s*t\s*$",
    )),
    ("introduction", (
        r"(?i)^\s*(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+introduction\s*$",
        r"(?i)^\s*introduction\s*$",
        r"(?i)^\s*i\.?\s+introduction\s*$",
    )),
    ("related_work", (
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?related\s+work\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?related\s+research\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?background(\s+and\s+related\s+work)?\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?literature\s+review\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?previous\s+work\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?state\s+of\s+the\s+art\s*$",
    )),
    ("background", (
        r"(?i)^\s*(?:\d+[\.\)]\s*)?background\s*$",
        r"(?i)^\s*(?:\d+[\.\)]\s*)?preliminaries?\s*$",
        r"(?i)^\s*(?:\d+[\.\)]\s*)?problem\s+(statement|formulation|definition)\s*$",
    )),
    ("method", (
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?(?:our\s+)?(?:proposed\s+)?(?:method|methodology|approach|model|framework|architecture|system|algorithm)s?\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?(?:problem\s+formulation|technical\s+approach|model\s+design|training\s+(?:procedure|strategy|methodology)|system\s+implementation|implementation\s+details|optimization)\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?(?:the\s+)?[A-Za-z0-9][A-Za-z0-9\- ]{1,60}\s+(?:method|approach|model|framework|architecture|algorithm)\s*$",
    )),
    ("experiments", (
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?experiments?(?:\s+and\s+results?)?\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?experimental\s+(setup|results?|evaluation|design)\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?evaluation\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?results?(?:\s+and\s+(analysis|discussion))?\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?empirical\s+(study|evaluation|results)\s*$",
    )),
    ("discussion", (
        r"(?i)^\s*(?:\d+[\.\)]\s*)?discussion\s*$",
        r"(?i)^\s*(?:\d+[\.\)]\s*)?(general\s+)?discussion\s*$",
        r"(?i)^\s*(?:\d+[\.\)]\s*)?analysis(\s+and\s+discussion)?\s*$",
    )),
    ("limitations", (
        r"(?i)^\s*(?:\d+(?:\.\d+)*[\.\)]?\s+)?limitations?\s*$",
        r"(?i)^\s*(?:\d+(?:\.\d+)*[\.\)]?\s+)?(?:study\s+)?limitations?\s+and\s+future\s+work\s*$",
    )),
    ("conclusion", (
        r"(?i)^\s*(?:\d+[\.\)]\s*)?conclusions?(?:\s+and\s+(future\s+)?(work|outlook|directions))?\s*$",
        r"(?i)^\s*(?:\d+[\.\)]\s*)?summary(\s+and\s+conclusions?)?\s*$",
        r"(?i)^\s*(?:\d+[\.\)]\s*)?concluding\s+remarks\s*$",
        r"(?i)^\s*(?:\d+[\.\)]\s*)?future\s+work\s*$",
    )),
    ("acknowledgments", (
        r"(?i)^\s*(?:\d+[\.\)]\s*)?acknowledg?ments?\s*$",
        r"(?i)^\s*(?:\d+[\.\)]\s*)?acknowledgements?\s*$",
    )),
    ("references", (
        r"(?i)^\s*(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+references?\s*$",
        r"(?i)^\s*references?\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?bibliography\s*$",
        r"(?i)^\s*(?:(?:(?:\d+(?:\.\d+)*)|[IVXLC]+)[\.\)]?\s+)?works\s+cited\s*$",
    )),
)

# Broad sweep terms and the years that searches cover (first and last).
SWEEP_TERMS = ("deep learning", "neural network", "machine learning", "computational biology", "genomics", "protein structure")
VENUE_YEARS, SWEEP_YEARS = (2015, 2026), (2015, 2025)
ROWS_PER_SEARCH = 300
RUN_VERSION = 7

# Fixed values: (words a heading may contain, canonical section), the first that fits wins.
CANONICAL_SECTIONS = (
    (("reference", "bibliograph"), "references"),
    (("method", "methodology", "approach", "model", "framework", "architecture", "algorithm", "materials and methods", "experimental setup", "implementation", "training"), "method"),
    (("introduction",), "introduction"),
    (("result", "evaluation"), "experiments"),
    (("discussion",), "discussion"),
    (("limitation",), "limitations"),
    (("conclusion", "future work"), "conclusion"),
    (("related work", "background"), "related_work"),
)

# Markers that make a failure one of quality.
QUALITY_MARKERS = (
    "too short",
    "no cited-paper abstracts resolved",
    "too few cited-paper abstracts resolved",
    "invalid schema",
    "contains no tex",
    "too little article text",
    "lack a complete cited-paper abstract",
    "lack a complete abstract or citation context",
)

# Patterns of numbers, words, metric names and citation markers.
NUMBER = r"(?<![A-Za-z])[-+]?[0-9]+(?:\.[0-9]+)?%?"
LATIN_WORD = r"[A-Za-z]+"
METRIC = r"(?i)\b(?:AP|AP50|AP75|FLOPs?|top-?[15]|mAP|AUC|F1|params?)\b"
FIGURE_CAPTION = r"(?i)\bfig(?:ure)?\.?\s*\d+\s*:"
FRONT_MATTER = r"(?i)copyright|all rights reserved|corresponding author"
RIGHTS = r"(?i)copyright|all rights reserved"
IO_LISTING = r"(?i)\[t\]\s*input\s*:\s*output\s*:"
TABLE_DEBRIS = r"(?:#\d+|\bc\|)"
DOI = r"(?i)\b10\.\d{4,9}/[-._;()/:A-Z0-9]+"
ARXIV = r"(?i)(?:arxiv\s*:\s*|arxiv\.org/(?:abs|pdf)/|10\.48550/arxiv\.)([a-z-]+(?:\.[A-Z]{2})?/\d{7}|\d{4}\.\d{4,5})(?:v\d+)?"
YEAR_MARK = r"(?i)\b(?:19|20)\d{2}[a-z]?\b"
URL = r"(?i)https?://\S+|www\.\S+"
PMID = r"(?i)\bPMID\s*[: ]\s*(\d{5,10})\b"
ENTRY_LABEL = r"^\s*(?:\[\s*(\d+)\s*\]|(\d+)[.)])\s*"
REFERENCES_HEADING = r"(?im)^\s*(?:\d+(?:\.\d+)*[.)]?\s+)?(?:references?|bibliography|works\s+cited)\s*$"
NUMERIC_CITATION = r"\[([0-9,\s;–—-]+)\]"
ENDING = ".,;:)]}'\""
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl"}
