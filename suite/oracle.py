"""The registered queries in SQL, over the same tables.

Written from the meaning of each operator and not from its Spark form: row
numbers instead of ``min_by``, one plain join per lookup. Missing text is ''.
"""

from __future__ import annotations

from suite.bindings import AS_OF, CODE_HEADS, CODE_TAILS, EARLIER_REGION, LANGUAGES, REGION, SNAPSHOT, STATUSES

FLAGSHIP_MONTHS = 36


def clean(value: str) -> str:
    return f"nullif(trim({value}), '')"


def digits(value: str) -> str:
    return f"nullif(regexp_replace({value}, '[^0-9]', '', 'g'), '')"


def dotted(prefix: str, number: str) -> str:
    padded = f"lpad(cast({number} AS VARCHAR), 9, '0')"
    return f"('{prefix}' || " + " || '.' || ".join(f"substr({padded}, {i}, 3)" for i in (1, 4, 7)) + ")"


def pick(values: list[str], index: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][cast({index} % {len(values)} AS INTEGER) + 1]"


def postal_code(value: str) -> str:
    return f"coalesce(nullif(regexp_extract({value}, '\\b([0-9]{{4}})\\b', 1), ''), {clean(value)})"


def is_active(status: str) -> str:
    return f"coalesce(upper(trim({status})) IN ('AC', 'ACTIVE'), false)"


def status_label(status: str) -> str:
    return (
        f"CASE upper(trim({status})) WHEN 'AC' THEN 'ACTIVE' WHEN 'IN' THEN 'INACTIVE' ELSE trim({status}) END"
    )


def parse_date(value: str) -> str:
    formats = ", ".join(f"try_strptime(trim({value}), '{f}')" for f in ("%Y-%m-%d", "%d-%m-%Y", "%d/%m/%Y"))
    return f"cast(coalesce({formats}) AS DATE)"


def age(date: str) -> str:
    return f"cast({AS_OF.year * 12 + AS_OF.month} - (year({date}) * 12 + month({date})) AS INTEGER)"


def sector(code: str) -> str:
    c = f"replace(upper(trim({code})), ',', '.')"
    return f"""CASE WHEN {c} LIKE '96.02%' THEN 'beauty' WHEN {c} LIKE '56%' THEN 'horeca'
        WHEN {c} LIKE '86%' THEN 'health' WHEN {c} LIKE '47%' THEN 'retail'
        WHEN {c} LIKE '43%' OR {c} LIKE '81%' OR {c} LIKE '95%' THEN 'service_trades' ELSE 'other' END"""


LINE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"

# The raw tables and their mapping; nulls stand for missing values.
BASE = {
    "raw_enterprise": f"""
        SELECT {dotted('0', 'c_custkey')} AS EnterpriseNumber,
            CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS Denomination,
            {pick(STATUSES, 'c_custkey')} AS Status,
            CASE c_custkey % 7 WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y')
                WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 3 THEN ''
                WHEN 4 THEN '0000-00-00' WHEN 5 THEN 'not-a-date'
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS StartDate,
            CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN cast(9400 + c_nationkey AS VARCHAR)
                WHEN 2 THEN (9400 + c_nationkey) || ' ' || n_name ELSE 'B-' || (9400 + c_nationkey) END AS PostCode,
            CASE WHEN c_custkey % 6 = 0 THEN '' ELSE n_name END AS city,
            CASE WHEN c_custkey % 8 = 0 THEN 'https://c' || c_custkey || '.example' ELSE '' END AS website,
            c_custkey AS ord
        FROM customer JOIN orders ON c_custkey = o_orderkey JOIN nation ON c_nationkey = n_nationkey""",
    "raw_establishment": f"""
        SELECT CASE WHEN o_custkey % 11 = 4 THEN '' ELSE {dotted('0', 'o_custkey')} END AS EnterpriseNumber,
            {dotted('2.', 'o_orderkey')} AS EstablishmentNumber,
            CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE cast(9400 + o_orderkey % 25 AS VARCHAR) END AS PostCode,
            CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END AS StreetNL,
            o_orderkey AS ord
        FROM orders""",
    "raw_address": f"""
        SELECT CASE WHEN l_orderkey % 4 = 0 THEN '' ELSE {dotted('2.', 'l_orderkey')} END AS EntityNumber,
            (9400 + s_nationkey) || ' ' || n_name AS Zipcode, n_name AS MunicipalityNL, s_name AS StreetNL,
            cast(l_linenumber AS VARCHAR) AS HouseNumber,
            CASE WHEN l_partkey % 4 = 0 THEN 'A' ELSE '' END AS Box, {LINE_ORDER}
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "raw_activity": f"""
        SELECT {dotted('0', 'o_custkey')} AS EnterpriseNumber,
            CASE WHEN o_custkey % 9 = 0 THEN ''
                ELSE {pick(CODE_HEADS, 'l_partkey')} || {pick(CODE_TAILS, 'l_suppkey')} END AS nace_code,
            {LINE_ORDER}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_contact": f"""
        SELECT CASE WHEN event_type IN ('click', 'view') THEN {dotted('2.', 'event_id')}
                ELSE {dotted('0', '(user_id * 10 + event_id % 10)')} END AS EntityNumber,
            CASE event_type WHEN 'click' THEN 'EST' WHEN 'view' THEN 'vestiging' WHEN 'signup' THEN ''
                ELSE 'ENT' END AS EntityContact,
            CASE event_type WHEN 'click' THEN 'TEL' WHEN 'view' THEN 'EMAIL' WHEN 'purchase' THEN 'web'
                WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'FAX' ELSE 'TEL' END ELSE '' END AS ContactType,
            CASE WHEN event_type = 'signup' OR event_id % 11 = 0 THEN '' ELSE 'v' || event_id END AS Value,
            CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN '+32' || event_id ELSE '' END AS phone,
            CASE WHEN event_type = 'signup' AND event_id % 3 = 1 THEN 'u' || event_id || '@x.example'
                ELSE '' END AS email,
            event_id AS ord
        FROM events""",
    "raw_denomination": f"""
        SELECT {dotted('0', 'o_custkey')} AS EntityNumber,
            CASE WHEN o_custkey % 7 = 0 THEN '' ELSE p_name END AS Denomination,
            CASE l_returnflag WHEN 'N' THEN '001' WHEN 'R' THEN '002' ELSE '003' END AS TypeOfDenomination,
            {pick(LANGUAGES, 'l_suppkey')} AS Language, {LINE_ORDER}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "enterprise": f"""
        SELECT {digits('EnterpriseNumber')} AS enterprise_number, {clean('Denomination')} AS name,
            {clean('Status')} AS status, {clean('StartDate')} AS start_date, {clean('PostCode')} AS postal_code,
            {clean('city')} AS city, cast(NULL AS VARCHAR) AS address, {clean('website')} AS website, ord
        FROM raw_enterprise""",
    "establishment": f"""
        SELECT {digits('EnterpriseNumber')} AS enterprise_number,
            {digits('EstablishmentNumber')} AS establishment_number, {clean('StreetNL')} AS address,
            {clean('PostCode')} AS postal_code, cast(NULL AS VARCHAR) AS city, ord
        FROM raw_establishment""",
    "address": f"""
        SELECT {digits('EntityNumber')} AS establishment_number,
            trim(StreetNL) || ' ' || trim(HouseNumber)
                || CASE WHEN trim(Box) <> '' THEN ' box ' || trim(Box) ELSE '' END AS address,
            {clean('Zipcode')} AS postal_code, {clean('MunicipalityNL')} AS city, {LINE_ORDER}
        FROM raw_address""",
    "activity": f"""
        SELECT {digits('EnterpriseNumber')} AS enterprise_number, {clean('nace_code')} AS nace_code, {LINE_ORDER}
        FROM raw_activity""",
    "contact": f"""
        SELECT {digits('EntityNumber')} AS entity_number, upper({clean('EntityContact')}) AS entity_contact,
            upper({clean('ContactType')}) AS contact_type, {clean('Value')} AS value, {clean('phone')} AS phone,
            {clean('email')} AS email, cast(NULL AS VARCHAR) AS website, ord
        FROM raw_contact""",
    "denomination": f"""
        SELECT {digits('EntityNumber')} AS enterprise_number, {clean('Denomination')} AS denomination,
            {clean('TypeOfDenomination')} AS type, lower({clean('Language')}) AS language, {LINE_ORDER}
        FROM raw_denomination""",
}


def last_address(source: str) -> str:
    return f"""
        SELECT establishment_number, address, postal_code, city FROM {source}
        WHERE establishment_number IS NOT NULL AND (address IS NOT NULL OR postal_code IS NOT NULL)
        QUALIFY row_number() OVER (PARTITION BY establishment_number
            ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_shipdate DESC) = 1"""


LOOKUPS = {
    "latest": last_address("address"),
    "filled": """
        SELECT e.enterprise_number, e.establishment_number, coalesce(e.address, a.address) AS address,
            coalesce(e.postal_code, a.postal_code) AS postal_code, coalesce(e.city, a.city) AS city, e.ord
        FROM establishment e LEFT JOIN latest a USING (establishment_number)""",
    "primary_est": f"""
        SELECT enterprise_number, establishment_number, address AS est_address,
            {postal_code('postal_code')} AS est_postal_code, city AS est_city
        FROM filled WHERE enterprise_number IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY enterprise_number
            ORDER BY postal_code IS NULL, address IS NULL, ord) = 1""",
    "owner": """
        SELECT establishment_number, enterprise_number FROM establishment
        WHERE establishment_number IS NOT NULL AND enterprise_number IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY establishment_number ORDER BY ord DESC) = 1""",
    "contact_rows": """
        SELECT CASE WHEN coalesce(c.entity_contact IN ('EST', 'ESTABLISHMENT', 'VESTIGING'), false)
                THEN o.enterprise_number ELSE c.entity_number END AS enterprise_number,
            CASE WHEN contact_type = 'TEL' THEN value WHEN contact_type IN ('EMAIL', 'WEB', 'FAX') THEN NULL
                ELSE phone END AS phone,
            CASE WHEN contact_type = 'EMAIL' THEN value WHEN contact_type IN ('TEL', 'WEB', 'FAX') THEN NULL
                ELSE email END AS email,
            CASE WHEN contact_type = 'WEB' THEN value WHEN contact_type IN ('TEL', 'EMAIL', 'FAX') THEN NULL
                ELSE website END AS website,
            c.ord
        FROM contact c LEFT JOIN owner o ON c.entity_number = o.establishment_number
        WHERE c.entity_number IS NOT NULL""",
    "contacts": """
        SELECT enterprise_number, arg_min(phone, ord) FILTER (phone IS NOT NULL) AS phone,
            arg_min(email, ord) FILTER (email IS NOT NULL) AS email,
            arg_min(website, ord) FILTER (website IS NOT NULL) AS website
        FROM contact_rows WHERE enterprise_number IS NOT NULL GROUP BY enterprise_number""",
    "names": f"""
        SELECT enterprise_number, denomination FROM denomination
        WHERE enterprise_number IS NOT NULL AND denomination IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY enterprise_number ORDER BY
            CASE WHEN type IN ('001', '1') THEN 0 WHEN type IN ('002', '2') THEN 1 ELSE 2 END,
            CASE WHEN language IN ('nl', 'n') THEN 0 WHEN language IN ('fr', 'f') THEN 1
                WHEN language IN ('en', 'e') THEN 2 WHEN language IN ('de', 'd') THEN 3 ELSE 4 END,
            {LINE_ORDER}) = 1""",
    "codes": f"""
        SELECT enterprise_number, string_agg(nace_code, ',' ORDER BY {LINE_ORDER}) AS nace_codes
        FROM activity WHERE enterprise_number IS NOT NULL AND nace_code IS NOT NULL GROUP BY enterprise_number""",
    "first_codes": f"""
        SELECT enterprise_number, nace_code AS first_code FROM activity
        WHERE enterprise_number IS NOT NULL AND nace_code IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY enterprise_number ORDER BY {LINE_ORDER}) = 1""",
    "located": f"""
        SELECT e.enterprise_number, e.name, e.status, e.start_date, e.website,
            coalesce(p.est_address, e.address) AS address,
            coalesce(p.est_postal_code, {postal_code('e.postal_code')}) AS postal_code,
            coalesce(p.est_city, e.city) AS city, {postal_code('e.postal_code')} AS own_postal_code,
            p.est_postal_code, p.establishment_number, p.enterprise_number IS NOT NULL AS has_establishment, e.ord
        FROM enterprise e LEFT JOIN primary_est p USING (enterprise_number)""",
}

# The region-first run starts from these instead.
REGION_LIST = ", ".join(f"'{c}'" for c in REGION)
IN_AREA = {
    "area_address": f"""
        SELECT * FROM address
        WHERE establishment_number IS NOT NULL AND {postal_code('postal_code')} IN ({REGION_LIST})""",
    "area_establishment": """
        SELECT * FROM establishment WHERE enterprise_number IS NOT NULL
            AND establishment_number IN (SELECT establishment_number FROM area_address)""",
    "area_enterprise": """
        SELECT * FROM enterprise WHERE enterprise_number IN (SELECT enterprise_number FROM area_establishment)""",
    "area_activity": """
        SELECT * FROM activity WHERE enterprise_number IN (SELECT enterprise_number FROM area_establishment)""",
}


def area_lookups() -> dict[str, str]:
    """The lookups over the tables cut down to the region."""
    renamed = {}
    for name, sql in LOOKUPS.items():
        for table in ("establishment", "enterprise", "activity", "address"):
            for word in ("FROM", "JOIN"):
                sql = sql.replace(f"{word} {table} ", f"{word} area_{table} ").replace(
                    f"{word} {table}\n", f"{word} area_{table}\n"
                )
        renamed[name] = sql
    return renamed


SCORED = f"""
    SELECT l.enterprise_number, coalesce(l.name, n.denomination) AS name, {status_label('l.status')} AS status,
        l.start_date, l.address, l.postal_code, l.city, k.nace_codes, {sector('f.first_code')} AS sector_bucket,
        coalesce(c.website, l.website) AS website, c.phone, c.email, f.first_code,
        {age(parse_date('l.start_date'))} AS age_months, {is_active('l.status')} AS is_active, l.ord
    FROM located l LEFT JOIN contacts c USING (enterprise_number) LEFT JOIN names n USING (enterprise_number)
        LEFT JOIN codes k USING (enterprise_number) LEFT JOIN first_codes f USING (enterprise_number)"""

# Without contacts, names and activities.
SCORED_BASIC = f"""
    SELECT enterprise_number, name, {status_label('status')} AS status, start_date, address, postal_code, city,
        cast(NULL AS VARCHAR) AS nace_codes, 'other' AS sector_bucket, website, cast(NULL AS VARCHAR) AS phone,
        cast(NULL AS VARCHAR) AS email, cast(NULL AS VARCHAR) AS first_code,
        {age(parse_date('start_date'))} AS age_months, {is_active('status')} AS is_active, ord
    FROM located"""


def lead_columns(months: int, lite: bool = False) -> str:
    text = {c: f"coalesce({c}, '') AS {c}" for c in ("name", "start_date", "address", "postal_code", "city")}
    if lite:
        codes, sector_sql, total = "''", "''", "cast(0 AS INTEGER)"
        lead_in = "'lite_mode'"
        rules = ""
    else:
        codes, sector_sql = "coalesce(nace_codes, '')", "sector_bucket"
        total = f"""cast(greatest(0, least(100,
            CASE WHEN age_months <= {months} THEN 30 ELSE 0 END
            + CASE WHEN sector_bucket IN ('beauty', 'horeca', 'health') THEN 15 ELSE 0 END
            - CASE WHEN first_code IS NULL THEN 5 ELSE 0 END
            + CASE WHEN phone IS NOT NULL THEN 5 ELSE 0 END
            + CASE WHEN email IS NOT NULL THEN 3 ELSE 0 END)) AS INTEGER)"""
        lead_in = f"CASE WHEN age_months <= {months} THEN 'new<18m' END"
        rules = """CASE WHEN sector_bucket IN ('beauty', 'horeca', 'health') THEN 'sector_high' END,
            CASE WHEN first_code IS NULL THEN 'no_nace' END,"""
    return f"""coalesce(enterprise_number, '') AS enterprise_number, {text['name']}, status, {text['start_date']},
        {text['address']}, {text['postal_code']}, {text['city']}, {codes} AS nace_codes,
        {sector_sql} AS sector_bucket, CASE WHEN website IS NULL THEN 'no' ELSE 'yes' END AS has_website,
        coalesce(website, '') AS website, coalesce(phone, '') AS phone, coalesce(email, '') AS email,
        {total} AS score_total,
        concat_ws('|', {lead_in}, {rules}
            CASE WHEN phone IS NOT NULL THEN 'has_phone' END, CASE WHEN email IS NOT NULL THEN 'has_email' END,
            CASE WHEN website IS NOT NULL THEN 'has_website' END) AS score_reasons,
        '{SNAPSHOT}' AS source_files_version"""


def unchecked_sql(months: int = 18, codes: tuple[str, ...] = REGION, lite: bool = False) -> str:
    """Leads before the validity check, with ``ord``."""
    region = f"AND postal_code IN ({', '.join(repr(c) for c in codes)})" if codes else ""
    return f"""SELECT {lead_columns(months, lite)}, ord FROM scored
        WHERE is_active AND start_date IS NOT NULL AND age_months <= {months} {region}"""


VALID = "enterprise_number <> '' AND regexp_full_match(postal_code, '[0-9]{4}') AND score_total BETWEEN 0 AND 100"


def leads_sql(months: int = 18, codes: tuple[str, ...] = REGION, lite: bool = False) -> str:
    return f"SELECT * FROM ({unchecked_sql(months, codes, lite)}) WHERE {VALID}"


def with_tables(body: str, *extra: dict[str, str], area: bool = False, scored: str = SCORED) -> str:
    """A query over the mapped tables, the lookups and any further named tables."""
    lookups = {**IN_AREA, **area_lookups()} if area else LOOKUPS
    tables = {**BASE, **lookups, "scored": scored}
    for more in extra:
        tables.update(more)
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in tables.items()) + " " + body


def plain_select(table: str, columns: str) -> str:
    """All columns as text, missing as ''."""
    texts = ", ".join(f"coalesce({c}, '') AS {c}" for c in columns.split())
    return f"SELECT {texts} FROM {table}"


NOT_ORD = "SELECT * EXCLUDE (ord) FROM"
LEADS = {"found": leads_sql()}
ALL_LEADS = {"found": leads_sql(codes=())}
ENTERPRISE_COLUMNS = "enterprise_number name status start_date postal_code city address website"
PLACE_COLUMNS = "enterprise_number establishment_number address postal_code city"

# What ``dedupe`` compares: lower-case words joined by one space.
WORDS = "trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def dedupe_key(name: str, address: str) -> str:
    text = f"({WORDS.format(name)} || '|' || {WORDS.format(address)})"
    return f"CASE WHEN {text} <> '|' THEN sha256({text}) END"


UNCHECKED = f"""SELECT * REPLACE (CASE WHEN cast(substr(enterprise_number, 2) AS BIGINT) % 13 = 0 THEN ''
    ELSE postal_code END AS postal_code) FROM ({unchecked_sql(codes=())})"""
PROFILED = f"FROM located WHERE {is_active('status')}"


def flags(contacts: str = "contacts") -> str:
    return f"""SELECT {is_active('l.status')} AS active, l.start_date IS NOT NULL AS dated, l.has_establishment,
        c.enterprise_number IS NOT NULL AS has_contact, coalesce(l.postal_code IN ({REGION_LIST}), false) AS here
        FROM located l LEFT JOIN {contacts} c USING (enterprise_number)"""


FUNNEL = """count(*) AS loaded, count(*) FILTER (active) AS active,
    count(*) FILTER (active AND has_establishment) AS with_establishment,
    count(*) FILTER (active AND has_contact) AS with_contact,
    count(*) FILTER (active AND dated AND here) AS after_postcode"""


def kept(relation: str, key: str) -> str:
    return f"SELECT '{relation}' AS relation, {key} AS number, count(*) AS kept FROM area_{relation} GROUP BY {key}"


def loaded(relation: str, usable: str) -> str:
    reached = "(SELECT count(*) FROM contacts)" if relation == "contact" else "CAST(NULL AS BIGINT)"
    return f"""SELECT '{relation}' AS relation, count(*) AS loaded, count(*) FILTER ({usable}) AS usable,
        {reached} AS enterprises FROM {relation}"""


GAPS = f"""
    SELECT e.enterprise_number, {sector('f.first_code')} AS sector, f.first_code, c.phone, c.email, e.ord,
        coalesce({parse_date('e.start_date')} >= TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 18 MONTH, false) AS recent
    FROM enterprise e LEFT JOIN first_codes f USING (enterprise_number)
        LEFT JOIN contacts c USING (enterprise_number)"""

ORACLE: dict[str, str] = {
    "lead_basic": with_tables(f"{NOT_ORD} ({leads_sql(FLAGSHIP_MONTHS)})", scored=SCORED_BASIC),
    "leads_flagship": with_tables(f"{NOT_ORD} ({leads_sql(FLAGSHIP_MONTHS)})"),
    "leads": with_tables(f"{NOT_ORD} found", LEADS),
    "leads_every_region": with_tables(f"{NOT_ORD} found", ALL_LEADS),
    "leads_lite": with_tables(f"{NOT_ORD} ({leads_sql(lite=True)})"),
    "leads_region_first": with_tables(f"{NOT_ORD} found", LEADS, area=True),
    "leads_city": with_tables(f"{NOT_ORD} found WHERE contains(lower(city), 'nation_1')", ALL_LEADS),
    "leads_query": with_tables(
        f"""{NOT_ORD} ({leads_sql(FLAGSHIP_MONTHS, ())})
        WHERE contains(lower(name || ' ' || sector_bucket), 'beauty')"""
    ),
    "leads_min_score": with_tables(f"{NOT_ORD} found WHERE score_total >= 40", ALL_LEADS),
    "leads_first_n": with_tables(f"{NOT_ORD} (SELECT * FROM found ORDER BY ord LIMIT 25)", ALL_LEADS),
    "leads_top_scored": with_tables(
        f"{NOT_ORD} (SELECT * FROM found ORDER BY score_total DESC, ord LIMIT 25)", ALL_LEADS
    ),
    "leads_preview": with_tables(
        """SELECT enterprise_number, name, postal_code, city, phone, email, website
        FROM found ORDER BY ord LIMIT 3""",
        LEADS,
    ),
    "map_enterprise": with_tables(plain_select("enterprise", ENTERPRISE_COLUMNS)),
    "map_establishment": with_tables(plain_select("establishment", PLACE_COLUMNS)),
    "build_address": with_tables(plain_select("address", "establishment_number address postal_code city")),
    "map_activity": with_tables(plain_select("activity", "enterprise_number nace_code")),
    "map_contact": with_tables(
        plain_select("contact", "entity_number entity_contact contact_type value phone email website")
    ),
    "map_denomination": with_tables(plain_select("denomination", "enterprise_number denomination type language")),
    "normalize_ids": with_tables(f"SELECT EntityNumber AS raw_id, {digits('EntityNumber')} AS id FROM raw_contact"),
    "normalize_status": with_tables(
        f"""SELECT EnterpriseNumber AS enterprise, Status AS raw_status, {status_label('Status')} AS status,
        {is_active('Status')} AS is_active FROM raw_enterprise"""
    ),
    "active_only": with_tables(
        plain_select("enterprise", ENTERPRISE_COLUMNS) + f" WHERE {is_active('status')} AND start_date IS NOT NULL"
    ),
    "parse_dates": with_tables(
        f"""SELECT EnterpriseNumber AS enterprise, StartDate AS raw_date, {parse_date('StartDate')} AS start_date
        FROM raw_enterprise"""
    ),
    "young_only": with_tables(
        plain_select("enterprise", ENTERPRISE_COLUMNS) + f" WHERE {age(parse_date('start_date'))} <= 18"
    ),
    "age_months": with_tables(f"SELECT enterprise_number, {age(parse_date('start_date'))} AS age_months FROM enterprise"),
    "normalize_postcodes": with_tables(
        f"""SELECT EnterpriseNumber AS enterprise, PostCode AS raw_code,
        coalesce({postal_code('PostCode')}, '') AS postal_code FROM raw_enterprise"""
    ),
    "sector_bucket": with_tables(
        f"""SELECT EnterpriseNumber AS enterprise, replace(upper(trim(nace_code)), ',', '.') AS code,
        {sector('nace_code')} AS sector_bucket FROM raw_activity"""
    ),
    "ensure_bucket": with_tables(
        f"""SELECT enterprise, outside, CASE WHEN lower(trim(outside)) IN ('beauty', 'horeca', 'health', 'retail',
            'service_trades', 'other') THEN lower(trim(outside)) ELSE 'other' END AS sector_bucket
        FROM (SELECT EnterpriseNumber AS enterprise, ' ' || upper({sector('nace_code')})
            || CASE WHEN nace_code = '' THEN '?' ELSE ' ' END AS outside FROM raw_activity)"""
    ),
    "score_record": with_tables(
        f"""SELECT enterprise_number, sector_bucket, has_website, score_total, score_reasons
        FROM (SELECT {lead_columns(18)} FROM scored)"""
    ),
    "score_gaps": with_tables(
        """SELECT enterprise_number, sector,
            cast(CASE WHEN recent THEN 30 ELSE 0 END
                + CASE WHEN sector IN ('beauty', 'horeca', 'health') THEN 15 ELSE 0 END
                + CASE WHEN phone IS NULL THEN 5 ELSE 0 END + CASE WHEN email IS NULL THEN 5 ELSE 0 END
                - CASE WHEN first_code IS NULL THEN 5 ELSE 0 END AS INTEGER) AS score_total,
            concat_ws('|', CASE WHEN recent THEN 'new<18m;+30' END,
                CASE WHEN sector IN ('beauty', 'horeca', 'health') THEN 'sector;+15' END,
                CASE WHEN phone IS NULL THEN 'missing_phone;+5' END,
                CASE WHEN email IS NULL THEN 'missing_email;+5' END,
                CASE WHEN first_code IS NULL THEN 'missing_nace;-5' END) AS score_reasons
        FROM gaps""",
        {"gaps": GAPS},
    ),
    "address_latest": with_tables(plain_select("latest", "establishment_number address postal_code city")),
    "establishment_filled": with_tables(plain_select("filled", PLACE_COLUMNS)),
    "primary_establishment": with_tables(
        plain_select("primary_est", "enterprise_number establishment_number est_address est_postal_code est_city")
    ),
    "enterprise_located": with_tables(
        plain_select(
            "located",
            """enterprise_number name status start_date website address postal_code city own_postal_code
            est_postal_code establishment_number""",
        ).replace(" FROM located", ", has_establishment FROM located")
    ),
    "establishment_owner": with_tables("SELECT establishment_number, enterprise_number FROM owner"),
    "contacts_resolved": with_tables(
        plain_select("contact_rows", "enterprise_number phone email website")
        + " WHERE enterprise_number IS NOT NULL"
    ),
    "contacts_best": with_tables(plain_select("contacts", "enterprise_number phone email website")),
    "denomination_best": with_tables("SELECT enterprise_number, denomination FROM names"),
    "activity_codes": with_tables(
        "SELECT enterprise_number, nace_codes, first_code FROM codes JOIN first_codes USING (enterprise_number)"
    ),
    "activity_first": with_tables("SELECT enterprise_number, first_code FROM first_codes"),
    "region_prefilter": with_tables(
        " UNION ALL ".join(
            [
                kept("address", "establishment_number"),
                kept("establishment", "establishment_number"),
                kept("enterprise", "enterprise_number"),
                kept("activity", "enterprise_number"),
            ]
        ),
        area=True,
    ),
    "region_filter_table": with_tables(
        f"""SELECT enterprise_number, {postal_code('postal_code')} AS postal_code FROM enterprise
        WHERE {postal_code('postal_code')} IN (SELECT {postal_code('postal_code')} FROM establishment)"""
    ),
    "sector_top10": with_tables(
        """SELECT sector_bucket, leads FROM (
            SELECT sector_bucket, count(*) AS leads, min(place) AS seen
            FROM (SELECT *, row_number() OVER (ORDER BY score_total DESC, ord) AS place FROM found)
            GROUP BY sector_bucket) ORDER BY leads DESC, seen LIMIT 10""",
        ALL_LEADS,
    ),
    "postcode_profile": with_tables(
        f"""SELECT count(*) AS total, count(*) FILTER (postal_code IS NULL) AS empty,
        count(postal_code) AS non_empty {PROFILED}"""
    ),
    "postcode_top10": with_tables(
        f"""SELECT postal_code, count(*) AS enterprises {PROFILED} AND postal_code IS NOT NULL
        GROUP BY postal_code ORDER BY count(*) DESC, min(ord) LIMIT 10"""
    ),
    "postcode_sample": with_tables(
        f"""SELECT coalesce(enterprise_number, '') AS enterprise_number,
            coalesce(establishment_number, '') AS establishment_number,
            coalesce(postal_code, '') AS computed_postcode, coalesce(est_postal_code, '') AS est_postal_code,
            coalesce(own_postal_code, '') AS enterprise_postal_code,
            CASE WHEN has_establishment
                THEN 'address,city,enterprise_number,establishment_number,postal_code' ELSE '' END AS est_keys
        {PROFILED} ORDER BY ord LIMIT 3"""
    ),
    "result_profile": with_tables(
        f"""SELECT count(*) AS total_records, count(DISTINCT enterprise_number) AS unique_enterprises,
        min({parse_date('start_date')}) AS min_start_date, max({parse_date('start_date')}) AS max_start_date
        FROM found""",
        LEADS,
    ),
    "result_sample_ids": with_tables(
        "SELECT DISTINCT enterprise_number FROM found ORDER BY enterprise_number LIMIT 10", LEADS
    ),
    "join_coverage": with_tables(
        """SELECT enterprises, with_establishment, with_contact,
            100.0::DOUBLE * with_establishment / enterprises AS establishment_percent,
            100.0::DOUBLE * with_contact / enterprises AS contact_percent
        FROM (SELECT count(*) AS enterprises, count(*) FILTER (has_establishment) AS with_establishment,
            count(*) FILTER (has_contact) AS with_contact FROM flags)""",
        {"flags": flags()},
    ),
    "stage_funnel": with_tables(f"SELECT {FUNNEL} FROM flags", {"flags": flags()}),
    "region_funnel": with_tables(
        f"""SELECT {FUNNEL},
            (SELECT count(DISTINCT establishment_number) FROM area_address) AS establishments_in_area,
            (SELECT count(DISTINCT enterprise_number) FROM area_establishment) AS enterprises_in_area
        FROM flags""",
        {"flags": flags()},
        area=True,
    ),
    "load_counts": with_tables(
        " UNION ALL ".join(
            loaded(relation, usable)
            for relation, usable in {
                "enterprise": "true",
                "establishment": "true",
                "address": "establishment_number <> '' AND (address IS NOT NULL OR postal_code IS NOT NULL)",
                "activity": "enterprise_number <> '' AND nace_code IS NOT NULL",
                "contact": "true",
                "denomination": "enterprise_number <> '' AND denomination IS NOT NULL",
            }.items()
        )
    ),
    "valid_leads": with_tables(f"{NOT_ORD} unchecked WHERE {VALID}", {"unchecked": UNCHECKED}),
    "rejected_leads": with_tables(
        f"""SELECT * EXCLUDE (ord), CASE WHEN enterprise_number = '' THEN 'enterprise_number'
            WHEN NOT regexp_full_match(postal_code, '[0-9]{{4}}') THEN 'postal_code' ELSE 'score_total' END
            AS reject_reason
        FROM unchecked WHERE NOT ({VALID})""",
        {"unchecked": UNCHECKED},
    ),
    "usable_leads": with_tables(
        f"""{NOT_ORD} found WHERE name <> '' AND postal_code <> '' AND city <> ''
        AND (phone <> '' OR email <> '' OR website <> '')""",
        ALL_LEADS,
    ),
    "dedupe_in_run": with_tables(
        f"""SELECT coalesce(enterprise_number, '') AS enterprise_number, name, address,
            coalesce(dedupe_key, '') AS dedupe_key
        FROM (SELECT *, {dedupe_key('name', 'address')} AS dedupe_key
            FROM (SELECT enterprise_number, coalesce(denomination, '') AS name, coalesce(language, '') AS address,
                {LINE_ORDER} FROM denomination))
        QUALIFY dedupe_key IS NULL OR row_number() OVER (PARTITION BY dedupe_key ORDER BY {LINE_ORDER}) = 1"""
    ),
    "dedupe_cross_run": with_tables(
        f"""SELECT * EXCLUDE (ord), {dedupe_key('name', 'address')} AS dedupe_key FROM found
        WHERE coalesce({dedupe_key('name', 'address')} NOT IN (
            SELECT {dedupe_key('name', 'address')} FROM earlier
            WHERE {dedupe_key('name', 'address')} IS NOT NULL), true)""",
        {"found": leads_sql(FLAGSHIP_MONTHS), "earlier": leads_sql(FLAGSHIP_MONTHS, EARLIER_REGION)},
    ),
    "csv_roundtrip": "SELECT cast(doc_id AS VARCHAR) AS doc_id, source, text FROM documents",
    "csv_strict_rows": """SELECT cast(event_id AS VARCHAR) AS event_id, event_type FROM events
        WHERE event_type <> 'error'""",
    "csv_latin1": "SELECT cast(c_custkey AS VARCHAR) AS id, 'Café ' || c_name AS name FROM customer",
    "synonym_rename": with_tables(
        """SELECT EnterpriseNumber AS enterprise_number, Status AS status, StartDate AS start_date,
        PostCode AS postal_code, city FROM raw_enterprise"""
    ),
    "provider_normalize": """SELECT cast(c_custkey AS VARCHAR) AS enterprise_number, c_name AS name,
        c_mktsegment AS address, '' AS postal_code, '' AS city, '' AS phone, '' AS email, '' AS website,
        'provider-template' AS source_files_version FROM customer""",
    "provider_search": """SELECT cast(c_custkey AS VARCHAR) AS enterprise_number, c_name AS name,
        c_mktsegment AS address, '' AS postal_code, '' AS city, '' AS phone, '' AS email, '' AS website,
        'provider-template' AS source_files_version, '' AS sector_bucket
        FROM customer WHERE contains(lower(c_name), 'customer#0000000')""",
}


# The same leads whichever way the tables come in, and without contacts and names.
NO_CONTACTS = {
    "contacts": """SELECT cast(NULL AS VARCHAR) AS enterprise_number, cast(NULL AS VARCHAR) AS phone,
        cast(NULL AS VARCHAR) AS email, cast(NULL AS VARCHAR) AS website WHERE false""",
    "names": "SELECT cast(NULL AS VARCHAR) AS enterprise_number, cast(NULL AS VARCHAR) AS denomination WHERE false",
}
ORACLE |= {
    "leads_from_snapshot": ORACLE["leads"],
    "leads_from_snapshot_no_contacts": with_tables(f"{NOT_ORD} found", NO_CONTACTS, LEADS),
    "export_with_quarantine": f"""SELECT *, '' AS reject_reason FROM ({ORACLE["valid_leads"]})
        UNION ALL BY NAME SELECT * FROM ({ORACLE["rejected_leads"]})""",
    "csv_mixed_headers": """SELECT cast(c_custkey AS VARCHAR) AS id, c_name,
        CASE WHEN c_custkey % 3 = 2 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
    "csv_stray_quotes": "SELECT cast(p_partkey AS VARCHAR) AS id, '5\" ' || p_name AS name, 'x' AS mark FROM part",
    "columns_by_keyword": with_tables(plain_select("establishment", PLACE_COLUMNS)),
    "table_by_stem": with_tables("SELECT EnterpriseNumber AS enterprise_number, Status AS status FROM raw_enterprise"),
    "provider_by_country": ORACLE["provider_normalize"],
    "leads_ranked": with_tables(
        """SELECT * EXCLUDE (ord), cast(row_number() OVER (ORDER BY score_total DESC, ord) AS INTEGER) AS place
        FROM found ORDER BY score_total DESC, ord LIMIT 50""",
        ALL_LEADS,
    ),
    "gaps_ranked": with_tables(
        """SELECT *, cast(row_number() OVER (ORDER BY score_total DESC, ord) AS INTEGER) AS place
        FROM (SELECT enterprise_number, sector, ord,
            cast(CASE WHEN recent THEN 30 ELSE 0 END
                + CASE WHEN sector IN ('beauty', 'horeca', 'health') THEN 15 ELSE 0 END
                + CASE WHEN phone IS NULL THEN 5 ELSE 0 END + CASE WHEN email IS NULL THEN 5 ELSE 0 END
                - CASE WHEN first_code IS NULL THEN 5 ELSE 0 END AS INTEGER) AS score_total
            FROM gaps)
        ORDER BY score_total DESC, ord LIMIT 50""",
        {"gaps": GAPS},
    ),
}
ORACLE["gaps_ranked"] = f"SELECT * EXCLUDE (ord) FROM ({ORACLE['gaps_ranked']})"

BY_NUMBER = "cast(substr(enterprise_number, 2) AS BIGINT)"
OF_SNAPSHOT = "SELECT * REPLACE ('{0}' AS source_files_version) FROM ({1}) WHERE {2}"
ORACLE |= {
    "lead_run_split": with_tables(
        f"""SELECT * EXCLUDE (ord), '' AS reject_reason FROM (SELECT * FROM unchecked WHERE {VALID} ORDER BY ord LIMIT 40)
        UNION ALL SELECT * EXCLUDE (ord), CASE WHEN enterprise_number = '' THEN 'enterprise_number'
            WHEN NOT regexp_full_match(postal_code, '[0-9]{{4}}') THEN 'postal_code' ELSE 'score_total' END
        FROM unchecked WHERE NOT ({VALID})""",
        {"unchecked": unchecked_sql(FLAGSHIP_MONTHS, codes=())},
    ),
    "address_first_rows": with_tables(
        "SELECT coalesce(establishment_number, '') AS establishment_number, coalesce(address, '') AS address, "
        "coalesce(postal_code, '') AS postal_code, coalesce(city, '') AS city "
        f"FROM (SELECT * FROM address ORDER BY {LINE_ORDER} LIMIT 20000)"
    ),
    "sector_rules": with_tables(
        """SELECT coalesce(enterprise_number, '') AS enterprise_number, coalesce(nace_code, '') AS nace_code,
            coalesce((SELECT r.sector FROM rules r WHERE starts_with(replace(upper(nace_code), ',', '.'), r.prefix)
                ORDER BY len(r.prefix) DESC LIMIT 1), 'other') AS sector_bucket
        FROM activity""",
        {
            "rules": f"""SELECT {pick(CODE_HEADS, 'p_partkey')} || ['', '.0', '.02', '02', '9'][cast(p_size % 5 AS INTEGER) + 1] AS prefix,
                min(p_brand) AS sector FROM part WHERE p_partkey % 8 > 1 GROUP BY prefix"""
        },
    ),
    "leads_of_snapshots": OF_SNAPSHOT.format("2001-01", ORACLE["leads"], "true")
    + " UNION ALL "
    + OF_SNAPSHOT.format("2001-02", ORACLE["leads"], f"{BY_NUMBER} % 2 = 0"),
    "enterprise_as_of": f"""SELECT * REPLACE (CASE WHEN {BY_NUMBER} % 3 <> 0 THEN 'Stopped' ELSE status END AS status)
        FROM ({with_tables(plain_select("enterprise", ENTERPRISE_COLUMNS))}) WHERE {BY_NUMBER} % 3 <> 0 OR {BY_NUMBER} % 5 <> 0""",
    "dedupe_three_runs": with_tables(
        f"""SELECT cast(step AS INTEGER) AS step, dedupe_key, count(*) AS rows
        FROM (SELECT *, min(own) OVER (PARTITION BY dedupe_key) AS step FROM (
            SELECT {dedupe_key("coalesce(denomination, '')", "coalesce(language, '')")} AS dedupe_key,
                CASE WHEN {BY_NUMBER} % 6 = 0 THEN 1 WHEN {BY_NUMBER} % 3 = 0 THEN 2 ELSE 3 END AS own FROM denomination))
        WHERE dedupe_key IS NOT NULL AND own <= step GROUP BY step, dedupe_key"""
    ),
}

REPORTS = {
    "postcode_profile": "total empty non_empty",
    "join_coverage": "enterprises with_establishment with_contact",
    "stage_funnel": "loaded active with_establishment with_contact after_postcode",
}
ORACLE["run_report"] = " UNION ALL ".join(
    f"SELECT '{report}' AS report, measure, cast(value AS BIGINT) AS value FROM "
    f"(UNPIVOT (SELECT {', '.join(measures.split())} FROM ({ORACLE[report]})) ON COLUMNS(*) INTO NAME measure VALUE value)"
    for report, measures in REPORTS.items()
)
ORACLE["dry_run_count"] = with_tables("SELECT count(*) AS leads FROM found", ALL_LEADS)
