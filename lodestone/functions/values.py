"""Names, endings, patterns and limits that results depend on."""

# Names of attribution notices (compared without case).
NOTICE_NAMES = ["COPYING", "COPYING.lib", "LICENSE", "LICENSE.md", "LICENSE.txt", "LICENSE-Community.txt", "LICENSES", "NOTICE"]

# Parts and starts of license file names (upper case).
LICENSE_NAME_PARTS = ["LIC", "COPY"]
LICENSE_NAME_STARTS = ["NOTICE"]

# Endings of files that are not mined (compared without case).
IGNORED_ENDINGS = """
.1 .2 .3 .4 .5 .6 .7 .8 .9 .ac .adoc .am .asc .asciidoc .bmp .build .cfg .chm .cmake .cnf .conf .config
.contributors .copying .crt .csproj .css .csv .cvsignore .dat .data .db .doc .ds_store .dtd .dts .dtsi .dump
.eot .eps .geojson .gdoc .gif .gitignore .glif .gmo .gradle .guess .hex .htm .html .ico .in .inc .info .ini
.ipynb .jpeg .jpg .json .jsonld .log .m4 .map .markdown .md .md5 .meta .mk .mxml .o .otf .out .pbtxt .pdf .pem
.phtml .plist .png .po .ppt .prefs .properties .pyc .qdoc .result .rgb .rst .rtf .scss .sha .sha1 .sha2 .sha256
.sln .spec .sql .sub .svg .svn-base .tab .template .test .tex .tiff .toml .ttf .txt .utf-8 .vim .wav .whl .woff
.xht .xhtml .xls .xml .xpm .xsd .xul .yaml .yml .LAS .adk .asc .cif .cli .cosmo .deploy .dfm .dmm .fa .fasta
.fcb .flm .fna .gbr .gen .gro .hgtags .hh .ihex .kp .mpx .pdb .poly .prn .ps .ref .resx .smp .stg .tfa .tsv
.vcf .vhd .xy .xyz -DOC CHANGELOG CONFIG COPYING COPYING.LIB LICENSE LICENSE.MD LICENSE.TXT LICENSES MAKEFILE
NOTICE README SWIFTDOC TEXIDOC TODO VERSION
""".split()

# Endings of files that are listed but not archived.
UNARCHIVED_ENDINGS = [".min.js", ".MF", ".base64", ".s"]

# Parts of paths that are not mined.
IGNORED_PATH_PARTS = ["/__pycache__/", "/__pypackages__", "/_yardoc/", "/eggs/", "/htmlcov/", "/nbbuild/", "/nbdist/", "/nbproject/", "/venv/", "/wheels/"]

# Starts of contents that hold no source code.
IGNORED_STARTS = ["{", "[", "<!doc", "<?xml", "<html", "<ac3d"]

# MD5s of files that are never mined.
DENIED_FILES = """
0962291d6d367570bee5454721c17e11 0f3006e20d30987b4fdd49c4a0adf342 1244d3f2f28ecc6619157927aca95200
2c58c801945b382ae168280eb80092b6 327711a461a30ba31b918dc30a08ccae 34ea47c60598f102697b4476b742f873
375ddea382b6c56a7be2a967a20e0ab5 3a55d95595a6f9e37dee53826b4daff2 41876349cb12d6db992f1309f22df3f0
42679f369206e3da1495ed8abf870cee 443141a90f711430c1423855b273d2fa 448c34a56d699c29117adc64c43affeb
4a010b8264c9873452f055748133bb29 54542dc54ebae0de4502a1319144538f 72b0b8f922dc7f125c7aaed79f9d274a
76cdb2bad9582d23c1f6f4d868218d6c 80cb6cf2fe634fe0eaa8a32ce59bee73 8111d301bde6dd4875417be5a9d12fd5
86bc7f6bce545c75611d599acec5d494 8f68037672effa2917b28650c7cbce1f 93fb6cea8fc778af4030da1ceb7d4f60
96ba0a444d087ae06f32319ca4f0a3e4 97471e1a0beb9650905b574145ae4638 9c64fec71a86faf860632aca64da7ef1
a670520d9d36833b3e28d1e4b73cbe22 abd1ac26aaea8b55ff1eefd6caca1e55 b03f60eea43420aef3ecd1f96c455d97
c9eb740112b98a4ffa4b6e8965caa81f d3e3748e06793d488ae92138dd974ef8 de8ffdb592ab304b14832467aef77cb3
e24114dd1624e26140c00c0d49ba9837 e909b282419acd3b63f5fb68db3bbc9b f10f4e8a24a6f29f60f73caf7341f44d
fdb446fc9fbdb44dd511ce3d449504b0
""".split()

# Ids that stand for no file.
EMPTY_MD5, ZERO_MD5 = "d41d8cd98f00b204e9800998ecf8427e", "0" * 32

# Continuations of "copyright" that state nothing.
IGNORED_COPYRIGHT = [" notice", " ownership", " laws", " law.", "_", " and "]

# Limits in bytes, lines and counts.
MIN_FILE, HEADER, HEADER_LINES, COPYRIGHT_LINES = 256, 4096, 30, 20
MAX_LICENSE, MAX_COPYRIGHT = 1024, 256
MIN_COPYRIGHT_ALNUM, MAX_COPYRIGHT_MARKS = 3, 10
MAX_LINES, MAX_LINE_LENGTH, MAX_COMMENTS = 420, 72, 54
SQUARE_PERCENT, SQUARE_LINES, SQUARE_RANKS = 70, 500, 100
MAX_CSV_LINE, MAX_PATH, MAX_LINE_NUMBER = 1024, 4096, 65535

# Fields of each table's text form, in order.
TABLES = {
    "url": ["url_id", "vendor", "component", "version", "release_date", "license", "purl", "download_url"],
    "file": ["file_id", "url_id", "path"],
    "pivot": ["url_id", "file_id"],
    "license": ["id", "source", "spdx_id"],
    "copyright": ["id", "source", "statement"],
    "cryptography": ["id", "algorithm", "strength"],
    "quality": ["id", "source", "score"],
    "attribution": ["purl_id", "notice_id"],
    "dependency": ["id", "source", "vendor", "component", "version"],
    "purl": ["purl_id", "created", "latest", "updated", "star", "watch", "fork"],
    "vulnerability": ["id", "source", "purl", "version_from", "version_patched", "cve", "advisory", "severity", "date", "summary"],
}
VERSION = ["monthly", "daily"]
METADATA = ["vendor", "component", "version", "release_date", "license", "purl"]
