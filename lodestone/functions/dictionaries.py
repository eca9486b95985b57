"""Dictionaries of license wordings and cryptographic names.

The defaults are this library's own lists, from public license texts and public interfaces: some sentences and names, and
what a rule makes of titles and algorithms. Both can be replaced by tables of any size that the builders below read from definition files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.text import byte_view, normalised

LICENSES = [
    ("Apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "MIT License"),
    ("MIT", "under the MIT license"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("GPL-2.0-or-later", "either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0-or-later", "either version 3 of the License, or (at your option) any later version"),
    ("GPL-3.0-only", "under the terms of the GNU General Public License as published by the Free Software Foundation, version 3"),
    ("LGPL-2.1-or-later", "either version 2.1 of the License, or (at your option) any later version"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty"),
    ("CC0-1.0", "released under the Creative Commons CC0 1.0 Universal"),
    ("AGPL-3.0-or-later", "GNU Affero General Public License"),
]

CRYPTO = [
    ("AES", 256, "aes_cbc_encrypt aes_encrypt aes_decrypt aes_set_encrypt_key aes.h evp_aes_256_cbc"),
    ("DES", 56, "des_encrypt des_key_schedule des.h des_ecb_encrypt"),
    ("DESX", 184, "desx evp_desx_cbc"),
    ("3DES", 168, "des_ede3_cbc_encrypt 3des tripledes"),
    ("MD5", 128, "md5 md5_init md5_update md5_final md5.h"),
    ("SHA1", 160, "sha1 sha-1 sha1_init sha1_update sha1_final"),
    ("SHA2", 256, "sha256 sha-256 sha256_init sha512 sha-512 sha-1"),
    ("RC4", 128, "rc4 rc4_set_key arcfour arc4"),
    ("RSA", 2048, "rsa_size rsa_public_encrypt rsa_private_decrypt rsa.h"),
    ("DSA", 1024, "dsa_sign dsa_verify dsa.h"),
    ("ECDSA", 256, "ecdsa_sign ecdsa_verify ecdsa.h"),
    ("ChaCha", 256, "chacha20 chacha_init xchacha20"),
    ("Blowfish", 448, "blowfish bf_encrypt bf_set_key blowfish.h"),
    ("CRC32", 32, "crc32 crc32_combine"),
    ("HMAC", 256, "hmac_init hmac_update hmac.h"),
    ("Bcrypt", 192, "bcrypt bcrypt_hashpw"),
]


#: Titles of licenses by SPDX id; wordings are made of them by the rule below.
TITLES = [
    ("Apache-2.0", "Apache License, Version 2.0"), ("Apache-2.0", "Apache License 2.0"), ("Apache-1.1", "Apache Software License, Version 1.1"), ("MIT", "MIT License"), ("MIT", "Expat License"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-2-Clause", "Simplified BSD License"), ("BSD-3-Clause", "New BSD License"), ("BSD-4-Clause", "BSD 4-Clause License"),
    ("0BSD", "BSD Zero Clause License"), ("ISC", "ISC License"), ("GPL-2.0-only", "GNU General Public License version 2"), ("GPL-3.0-only", "GNU General Public License version 3"), ("GPL-2.0-only", "GPLv2"), ("GPL-3.0-only", "GPLv3"),
    ("LGPL-2.1-only", "GNU Lesser General Public License version 2.1"), ("LGPL-3.0-only", "GNU Lesser General Public License version 3"), ("LGPL-2.0-only", "GNU Library General Public License version 2"), ("LGPL-2.1-only", "LGPLv2.1"), ("LGPL-3.0-only", "LGPLv3"),
    ("AGPL-3.0-only", "GNU Affero General Public License version 3"), ("AGPL-3.0-only", "AGPLv3"), ("GFDL-1.3-only", "GNU Free Documentation License, Version 1.3"), ("MPL-1.1", "Mozilla Public License, Version 1.1"), ("MPL-2.0", "Mozilla Public License, Version 2.0"), ("MPL-2.0", "Mozilla Public License, v. 2.0"),
    ("EPL-1.0", "Eclipse Public License v1.0"), ("EPL-2.0", "Eclipse Public License v2.0"), ("EPL-2.0", "Eclipse Public License 2.0"), ("CDDL-1.0", "Common Development and Distribution License 1.0"), ("CPL-1.0", "Common Public License 1.0"), ("BSL-1.0", "Boost Software License, Version 1.0"),
    ("Zlib", "zlib License"), ("Unlicense", "Unlicense"), ("WTFPL", "Do What The F*ck You Want To Public License"), ("Artistic-1.0", "Artistic License 1.0"), ("Artistic-2.0", "Artistic License 2.0"), ("PSF-2.0", "Python Software Foundation License Version 2"),
    ("PHP-3.01", "PHP License, version 3.01"), ("Ruby", "Ruby License"), ("OpenSSL", "OpenSSL License"), ("PostgreSQL", "PostgreSQL License"), ("NCSA", "University of Illinois/NCSA Open Source License"), ("MS-PL", "Microsoft Public License"), ("MS-RL", "Microsoft Reciprocal License"),
    ("EUPL-1.2", "European Union Public Licence, Version 1.2"), ("OSL-3.0", "Open Software License 3.0"), ("AFL-3.0", "Academic Free License version 3.0"), ("CC0-1.0", "CC0 1.0 Universal"), ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"), ("OFL-1.1", "SIL Open Font License, Version 1.1"), ("UPL-1.0", "Universal Permissive License v 1.0"), ("BlueOak-1.0.0", "Blue Oak Model License 1.0.0"), ("MulanPSL-2.0", "Mulan PSL v2"),
]
USES = ["licensed under the {}", "licensed under {}", "under the terms of the {}", "distributed under the {}", "released under the {}", "subject to the terms of the {}", "covered by the {}"]

#: Names of algorithms with their bits, by kind; keywords are made of them by the rule below. Those that are words count only in it.
CIPHERS = "aes:256 aria:256 blowfish:448 camellia:256 cast5:128 cast6:256 chacha20:256 salsa20:256 des:56 des3:168 gost28147:256 hight:128 idea:128 kuznyechik:256 lea:256 mars:448 present:128 rc2:128 rc5:128 rc6:256 seed:128 serpent:256 simon:256 skipjack:80 sm4:128 speck:256 tea:128 threefish:1024 twofish:256 xtea:128 rijndael:256 xsalsa20:256"
HASHES = "md2:128 md4:128 md5:128 ripemd160:160 sha224:224 sha256:256 sha384:384 sha512:512 sha3:512 keccak:512 whirlpool:512 tiger:192 streebog:512 blake2b:512 blake2s:256 blake3:256 sm3:256 skein:512 haval:256"
SIGNERS = "rsa:2048 dsa:1024 ecdsa:256 eddsa:256 ed25519:256 ed448:456 ecdh:256 x25519:256 x448:448 elgamal:2048 diffie_hellman:2048"
KEYED = "hmac:256 cmac:128 gmac:128 poly1305:256 siphash:128 pbkdf2:256 scrypt:256 argon2:256 hkdf:256"
WORDS_TOO = set("aria hight idea lea mars present seed serpent simon speck tea tiger skein haval camellia".split())
FORMS = [
    (CIPHERS, "{0} {0}.h {0}_encrypt {0}_decrypt {0}_set_key {0}_setkey {0}_cbc_encrypt {0}_cbc_decrypt {0}_cbc {0}_ecb {0}_ctr {0}_ofb {0}_init {0}-cbc {0}-ctr {0}-gcm {0}-ecb {0}_cipher {0}_key_schedule evp_{0}_cbc evp_{0}_ecb"),
    (HASHES, "{0} {0}.h {0}_init {0}_update {0}_final {0}_transform {0}_digest {0}_ctx {0}sum {0}_hash hmac-{0} hmac_{0} evp_{0} {0}_compress"),
    (SIGNERS, "{0} {0}.h {0}_sign {0}_verify {0}_new {0}_free {0}_size {0}_generate_key {0}_private_key {0}_public_key {0}_keypair {0}_do_sign"),
    (KEYED, "{0} {0}.h {0}_init {0}_update {0}_final {0}_ctx {0}_digest {0}_derive {0}_key"),
]


def license_entries() -> list[tuple[int, str, str]]:
    """Whole sentences first, then every use of every title."""
    made = [(spdx, use.format(title)) for spdx, title in TITLES for use in USES]
    return [(i, spdx, phrase) for i, (spdx, phrase) in enumerate([*LICENSES, *made])]


def crypto_entries() -> list[tuple[int, str, str, int]]:
    flat = [(word, name, bits) for name, bits, words in CRYPTO for word in words.split()]
    for names, forms in FORMS:
        for name, _, bits in (n.partition(":") for n in names.split()):
            flat += [(word, name.upper(), int(bits)) for form in forms.split() if (word := form.format(name)) not in WORDS_TOO]
    return [(i, *x) for i, x in enumerate(flat)]


def license_dictionary(spark: SparkSession) -> DataFrame:
    """ord, spdx_id, phrase (normalised)."""
    raw = spark.createDataFrame(license_entries(), "ord int, spdx_id string, text string")
    return raw.select("ord", "spdx_id", normalised(byte_view(F.col("text")), 2**20).alias("phrase"))


def crypto_dictionary(spark: SparkSession) -> DataFrame:
    """ord, keyword, algorithm, strength."""
    return spark.createDataFrame(crypto_entries(), "ord int, keyword string, algorithm string, strength int")


def build_license_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary from a folder <SPDX id>/<any>.txt, one wording a file, in order of path."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    phrase = F.substring(normalised(byte_view(F.col("value")), 2**20), 1, 1023)
    named = files.select("path", F.element_at(F.split("path", "/"), -2).alias("spdx_id"), phrase.alias("phrase")).where("phrase <> ''")
    # A dictionary is small by nature: its entries are numbered in one task.
    return named.selectExpr("cast(row_number() OVER (ORDER BY path) - 1 AS int) AS ord", "spdx_id", "phrase")


def build_crypto_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary from files of lines name=..., coding=... and keywords. Keywords outside the token alphabet are left out."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.split("value", "\r?\n").alias("lines"))
    value = lambda key: F.expr(f"element_at(filter(lines, x -> lower(x) LIKE '{key}=%'), 1)")
    words = F.expr("filter(transform(lines, x -> trim(x)), x -> x NOT LIKE '%=%' AND x RLIKE '^[A-Za-z0-9*._-]+$')")
    wide = files.select("path", F.regexp_replace(value("name"), "^[^=]*=", "").alias("algorithm"), F.regexp_replace(value("coding"), "^[^=]*=", "").cast("int").alias("strength"), F.posexplode(words).alias("at", "keyword"))
    return wide.selectExpr("cast(row_number() OVER (ORDER BY path, at) - 1 AS int) AS ord", "keyword", "algorithm", "strength")


def first_keywords(dictionary: DataFrame) -> DataFrame:
    """One row for each keyword, without case: the first entry wins."""
    return dictionary.groupBy(F.lower("keyword").alias("keyword")).agg(F.min_by(F.struct("algorithm", "strength", "ord"), "ord").alias("e")).select("keyword", "e.algorithm", "e.strength", "e.ord")


def conflicts(dictionary: DataFrame) -> DataFrame:
    """inner_id, outer_id: wordings that a wording of another id contains, so that they hide it or are hidden by it.

    Every wording is compared with every other: dictionaries are small by nature.
    """
    a = dictionary.select(F.col("spdx_id").alias("inner_id"), F.col("phrase").alias("inner"))
    b = dictionary.select(F.col("spdx_id").alias("outer_id"), F.col("phrase").alias("outer"))
    return a.join(b, (F.col("inner_id") != F.col("outer_id")) & F.contains("outer", F.col("inner"))).select("inner_id", "outer_id")
