from allelic.functions.genotype import (  # noqa: F401
    bucket, child_number, classify_genotype, default_genotype, family_of,
    genotype_orientation, has_snp_data, hotspot_label, is_completion_token,
    is_het, is_rsid, normalize_chromosome, pct, person_key, person_role,
    rate_level, ratio, trend_direction, variant_type, zygosity,
)
