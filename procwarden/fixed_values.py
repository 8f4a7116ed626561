"""Fixed values.

Everything in this module is a constant whose value decides results: word
lists, lookup tables, patterns, thresholds, weights and message texts.  They
are kept in one place, as plain text, so that they can be reviewed and so that
the operators hold logic only.
"""

# ---------------------------------------------------------------------------
# Process name groups (lower-case base names)
# ---------------------------------------------------------------------------
KNOWN_BINARIES = [
    "certutil.exe", "mshta.exe", "regsvr32.exe", "rundll32.exe",
    "cscript.exe", "wscript.exe", "bitsadmin.exe", "msbuild.exe",
    "installutil.exe", "powershell.exe", "cmd.exe",
]
SCRIPT_ENGINES = ["powershell.exe", "cmd.exe", "cscript.exe", "wscript.exe", "mshta.exe"]
OFFICE_APPS = ["winword.exe", "excel.exe", "powerpnt.exe", "outlook.exe"]
BROWSERS = ["chrome.exe", "firefox.exe", "msedge.exe", "iexplore.exe"]
ROOT_PROCESSES = [
    "explorer.exe", "services.exe", "svchost.exe", "system",
    "wininit.exe", "csrss.exe", "smss.exe",
]
# Children that raise a chain score when the pair itself is not listed.
CHAIN_BINARIES = [
    "certutil.exe", "mshta.exe", "regsvr32.exe", "rundll32.exe", "cscript.exe",
    "wscript.exe", "bitsadmin.exe", "msbuild.exe", "installutil.exe",
]

# ---------------------------------------------------------------------------
# Command line substrings and patterns (matched on lower case)
# ---------------------------------------------------------------------------
SUSPICIOUS_FLAGS = [
    "-enc", "-nop", "-w hidden", "-windowstyle hidden", "/i:http", "-urlcache",
    "javascript:", "encodedcommand", "-decode", "-encode", "/transfer",
    "//e:jscript", "//e:vbscript", "-split -f", "-ep bypass", "-exec bypass",
    "-noni", "downloadstring", "downloadfile", "invoke-expression", "iex(",
    "hidden", "-noprofile",
]
DOWNLOAD_INDICATORS = [
    "urlcache", "/transfer", "download", "invoke-webrequest", "wget", "curl",
    "downloadstring", "downloadfile",
]
CHAIN_FLAGS = [
    "-nop", "-w hidden", "javascript:", "/i:http", "-urlcache", "/transfer",
    "//e:jscript",
]
URL_PATTERN = r"(?i)https?://"
IP_PATTERN = r"\b\p{Nd}{1,3}\.\p{Nd}{1,3}\.\p{Nd}{1,3}\.\p{Nd}{1,3}\b"
BASE64_PATTERN = r"[A-Za-z0-9+/]{40,}={0,2}"
# Every character that ends an argument token (Unicode white space), and the same as a pattern.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
WHITESPACE_PATTERN = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

# ---------------------------------------------------------------------------
# Integrity levels
# ---------------------------------------------------------------------------
INTEGRITY_CODES = {"Low": 0, "Medium": 1, "High": 2, "System": 3}
INTEGRITY_DEFAULT = 1

# ---------------------------------------------------------------------------
# Model input columns and their descriptions in explanations
# ---------------------------------------------------------------------------
MODEL_COLUMNS = [
    "is_known_lolbin", "is_scripting_engine", "command_line_length",
    "command_line_entropy", "has_suspicious_flag", "contains_url",
    "contains_ip_address", "has_base64_pattern", "argument_count",
    "suspicious_argument_ratio", "has_encoded_command", "has_download_indicator",
    "process_ancestry_depth", "parent_is_office_app", "parent_is_browser",
    "parent_is_script_engine", "hour_of_day", "is_off_hours", "is_weekend",
    "parent_child_pair_rarity", "command_length_zscore", "entropy_zscore",
    "is_system_user", "integrity_encoded",
]
FEATURE_DESCRIPTIONS = {
    "command_line_entropy": "high command line entropy (possible obfuscation)",
    "command_line_length": "unusually long command line",
    "is_known_lolbin": "process is a known LOLBin",
    "has_suspicious_flag": "suspicious command line flags detected",
    "contains_url": "URL found in command line",
    "contains_ip_address": "IP address in command line",
    "has_base64_pattern": "base64-encoded content detected",
    "has_encoded_command": "encoded PowerShell command",
    "has_download_indicator": "download activity indicator",
    "is_off_hours": "execution during off-hours (midnight-5am)",
    "is_weekend": "weekend execution",
    "parent_child_pair_rarity": "unusual parent-child process relationship",
    "command_length_zscore": "command length significantly above baseline",
    "entropy_zscore": "entropy significantly above baseline",
    "parent_is_office_app": "spawned by Office application",
    "parent_is_script_engine": "spawned by script engine",
    "suspicious_argument_ratio": "high ratio of suspicious arguments",
    "process_ancestry_depth": "deep process chain (possible multi-stage)",
    "argument_count": "unusual number of arguments",
    "is_scripting_engine": "scripting engine execution",
}
# Columns of the single-event detail view.
DETAIL_COLUMNS = [
    "is_known_lolbin", "is_scripting_engine", "command_line_length",
    "command_line_entropy", "has_suspicious_flag", "contains_url",
    "has_base64_pattern", "has_encoded_command", "has_download_indicator",
    "process_ancestry_depth", "parent_is_office_app", "is_off_hours",
    "parent_child_pair_rarity", "command_length_zscore", "entropy_zscore",
]

# ---------------------------------------------------------------------------
# ensemble
# ---------------------------------------------------------------------------
WEIGHTS = {"forest": 0.4, "lof": 0.3, "boundary": 0.3}
FOREST_TREES = 200
FOREST_SAMPLE = 256
LOF_NEIGHBOURS = 20
BOUNDARY_NU = 0.05
SEED = 42
ML_THRESHOLD = 70
CHAIN_THRESHOLD = 60
CHAIN_HIGH_RISK = 50
EXPLAIN_Z = 2.0
EXPLAIN_TOP = 5

# ---------------------------------------------------------------------------
# Suspicious (parent, child, base score, description) pairs
# ---------------------------------------------------------------------------
SUSPICIOUS_PAIRS = [
    ("winword.exe", "cmd.exe", 80, "Office Word spawning command shell (macro indicator)"),
    ("winword.exe", "powershell.exe", 85, "Office Word directly spawning PowerShell"),
    ("winword.exe", "mshta.exe", 85, "Office Word spawning HTA handler"),
    ("winword.exe", "wscript.exe", 80, "Office Word spawning Windows Script Host"),
    ("winword.exe", "cscript.exe", 80, "Office Word spawning CScript"),
    ("excel.exe", "cmd.exe", 80, "Excel spawning command shell (macro indicator)"),
    ("excel.exe", "powershell.exe", 85, "Excel directly spawning PowerShell"),
    ("powerpnt.exe", "cmd.exe", 80, "PowerPoint spawning command shell"),
    ("outlook.exe", "powershell.exe", 80, "Outlook spawning PowerShell"),
    ("outlook.exe", "cmd.exe", 75, "Outlook spawning command shell"),
    ("cmd.exe", "certutil.exe", 50, "Command shell invoking certutil"),
    ("powershell.exe", "certutil.exe", 65, "PowerShell invoking certutil"),
    ("cmd.exe", "regsvr32.exe", 55, "Command shell invoking regsvr32"),
    ("cmd.exe", "rundll32.exe", 50, "Command shell invoking rundll32"),
    ("cmd.exe", "bitsadmin.exe", 55, "Command shell invoking bitsadmin"),
    ("powershell.exe", "bitsadmin.exe", 60, "PowerShell invoking bitsadmin"),
    ("cmd.exe", "mshta.exe", 60, "Command shell invoking mshta"),
    ("powershell.exe", "msbuild.exe", 70, "PowerShell spawning MSBuild"),
    ("cmd.exe", "msbuild.exe", 65, "Command shell spawning MSBuild"),
    ("cmd.exe", "wscript.exe", 55, "Command shell invoking WScript"),
    ("cmd.exe", "cscript.exe", 55, "Command shell invoking CScript"),
    ("svchost.exe", "cmd.exe", 45, "Service host spawning command shell"),
    ("svchost.exe", "powershell.exe", 55, "Service host spawning PowerShell"),
    ("chrome.exe", "cmd.exe", 70, "Browser spawning command shell (possible exploit)"),
    ("chrome.exe", "powershell.exe", 75, "Browser spawning PowerShell (possible exploit)"),
    ("firefox.exe", "cmd.exe", 70, "Browser spawning command shell"),
    ("iexplore.exe", "cmd.exe", 70, "IE spawning command shell"),
    ("msedge.exe", "cmd.exe", 70, "Edge spawning command shell"),
    ("explorer.exe", "mshta.exe", 40, "Explorer launching HTA handler"),
    ("explorer.exe", "regsvr32.exe", 35, "Explorer launching regsvr32"),
    ("explorer.exe", "rundll32.exe", 25, "Explorer launching rundll32"),
]

# ---------------------------------------------------------------------------
# Severity order of rule levels
# ---------------------------------------------------------------------------
SEVERITY = {"critical": 4, "high": 3, "medium": 2, "low": 1}

# ---------------------------------------------------------------------------
# The ten detection rules.  A block is a list of
# (field|modifier, values) entries; a key may occur twice, as in the rule files
# (see ``duplicate_keys`` in operators.rules).
# ---------------------------------------------------------------------------
RULES = [
    {
        "filename": "bitsadmin_download.yml",
        "title": "BITSAdmin File Download",
        "id": "9b2a4d8e-3c0f-4a7b-fd1e-4l8c7a9b0d1e",
        "level": "high",
        "tags": ["attack.defense_evasion", "attack.persistence", "attack.t1197"],
        "description": "A BITS job that fetches a file from a URL.",
        "detection": [
            ("selection", [
                ("Image|endswith", "\\bitsadmin.exe"),
                ("CommandLine|contains", ["/transfer"]),
                ("CommandLine|contains", ["http://", "https://"]),
            ]),
            ("condition", "selection"),
        ],
    },
    {
        "filename": "certutil_download.yml",
        "title": "Certutil URL Cache Download",
        "id": "3b6a8d2e-7c4f-4a1b-9d5e-8f2c1a3b4d5e",
        "level": "high",
        "tags": ["attack.command_and_control", "attack.t1105"],
        "description": "certutil used to download through its URL cache.",
        "detection": [
            ("selection", [
                ("Image|endswith", "\\certutil.exe"),
                ("CommandLine|contains", ["-urlcache", "/urlcache"]),
            ]),
            ("filter", [("CommandLine|contains", ["-verify", "-hashfile"])]),
            ("condition", "selection and not filter"),
        ],
    },
    {
        "filename": "certutil_encode_decode.yml",
        "title": "Certutil Base64 Encode or Decode",
        "id": "2e5d7a1b-6f3c-4d0e-ca4b-7o1f0d2e3a4b",
        "level": "high",
        "tags": ["attack.defense_evasion", "attack.t1140"],
        "description": "certutil used to encode or decode a file.",
        "detection": [
            ("selection", [
                ("Image|endswith", "\\certutil.exe"),
                ("CommandLine|contains", ["-decode", "-encode", "/decode", "/encode"]),
            ]),
            ("condition", "selection"),
        ],
    },
    {
        "filename": "msbuild_execution.yml",
        "title": "MSBuild Inline Task Execution",
        "id": "0c3b5e9f-4d1a-4b8c-ae2f-5m9d8b0c1e2f",
        "level": "high",
        "tags": ["attack.defense_evasion", "attack.execution", "attack.t1127.001"],
        "description": "MSBuild run on a project in a user-writable folder.",
        "detection": [
            ("selection", [
                ("Image|endswith", "\\MSBuild.exe"),
                ("CommandLine|contains",
                 ["\\Users\\Public\\", "\\Temp\\", "\\AppData\\", "\\Downloads\\"]),
            ]),
            ("condition", "selection"),
        ],
    },
    {
        "filename": "mshta_remote_hta.yml",
        "title": "Mshta Remote HTA Execution",
        "id": "4c7b9e3f-8d5a-4b2c-ae6f-9g3d2b4c5e6f",
        "level": "high",
        "tags": ["attack.defense_evasion", "attack.t1218.005"],
        "description": "mshta given a remote page or an inline script.",
        "detection": [
            ("selection_remote", [
                ("Image|endswith", "\\mshta.exe"),
                ("CommandLine|contains", ["http://", "https://"]),
            ]),
            ("selection_vbscript", [
                ("Image|endswith", "\\mshta.exe"),
                ("CommandLine|contains", ["vbscript:", "javascript:"]),
            ]),
            ("condition", "selection_remote or selection_vbscript"),
        ],
    },
    {
        "filename": "office_spawns_shell.yml",
        "title": "Office Application Spawning Command Shell",
        "id": "8a1f3c7d-2b9e-4f6a-ec0d-3k7b6f8a9c0d",
        "level": "critical",
        "tags": ["attack.execution", "attack.t1204.002"],
        "description": "An Office program starting a shell or script host.",
        "detection": [
            ("selection", [
                ("ParentImage|endswith",
                 ["\\WINWORD.EXE", "\\EXCEL.EXE", "\\POWERPNT.EXE", "\\OUTLOOK.EXE"]),
                ("Image|endswith",
                 ["\\cmd.exe", "\\powershell.exe", "\\wscript.exe", "\\cscript.exe",
                  "\\mshta.exe"]),
            ]),
            ("condition", "selection"),
        ],
    },
    {
        "filename": "powershell_encoded.yml",
        "title": "PowerShell Encoded Command Execution",
        "id": "7f0e2b6c-1a8d-4e5f-db9c-2j6a5e7f8b9c",
        "level": "high",
        "tags": ["attack.execution", "attack.t1059.001"],
        "description": "PowerShell with an encoded command or hidden, profile-less start.",
        "detection": [
            ("selection_encoded", [
                ("Image|endswith", "\\powershell.exe"),
                ("CommandLine|contains", ["-enc ", "-EncodedCommand", "-ec "]),
            ]),
            ("selection_hidden", [
                ("Image|endswith", "\\powershell.exe"),
                ("CommandLine|contains",
                 ["-w hidden", "-WindowStyle Hidden", "-windowstyle hidden"]),
                ("CommandLine|contains", ["-nop", "-NoProfile"]),
            ]),
            ("condition", "selection_encoded or selection_hidden"),
        ],
    },
    {
        "filename": "regsvr32_squiblydoo.yml",
        "title": "Regsvr32 Squiblydoo Remote SCT Execution",
        "id": "5d8c0f4a-9e6b-4c3d-bf7a-0h4e3c5d6f7a",
        "level": "critical",
        "tags": ["attack.defense_evasion", "attack.t1218.010"],
        "description": "regsvr32 pointed at a remote scriptlet.",
        "detection": [
            ("selection", [
                ("Image|endswith", "\\regsvr32.exe"),
                ("CommandLine|contains", ["/i:http", "/i:https"]),
            ]),
            ("selection_scrobj", [
                ("Image|endswith", "\\regsvr32.exe"),
                ("CommandLine|contains", "scrobj.dll"),
            ]),
            ("condition", "selection or selection_scrobj"),
        ],
    },
    {
        "filename": "rundll32_javascript.yml",
        "title": "Rundll32 JavaScript Execution",
        "id": "6e9d1a5b-0f7c-4d4e-ca8b-1i5f4d6e7a8b",
        "level": "critical",
        "tags": ["attack.defense_evasion", "attack.t1218.011"],
        "description": "rundll32 used to run inline script.",
        "detection": [
            ("selection", [
                ("Image|endswith", "\\rundll32.exe"),
                ("CommandLine|contains",
                 ["javascript:", "vbscript:", "RunHTMLApplication"]),
            ]),
            ("condition", "selection"),
        ],
    },
    {
        "filename": "wscript_remote.yml",
        "title": "WScript or CScript Remote Script Execution",
        "id": "1d4c6f0a-5e2b-4c9d-bf3a-6n0e9c1d2f3a",
        "level": "high",
        "tags": ["attack.execution", "attack.t1059.005"],
        "description": "A script host given a URL or an explicit engine.",
        "detection": [
            ("selection_remote", [
                ("Image|endswith", ["\\wscript.exe", "\\cscript.exe"]),
                ("CommandLine|contains", ["http://", "https://"]),
            ]),
            ("selection_engine", [
                ("Image|endswith", ["\\wscript.exe", "\\cscript.exe"]),
                ("CommandLine|contains", ["//e:jscript", "//e:vbscript"]),
            ]),
            ("condition", "selection_remote or selection_engine"),
        ],
    },
]
