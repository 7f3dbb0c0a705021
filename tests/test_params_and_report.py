"""Report parameters: NULL list parameters, 'ALL' header, ' All' corp sentinel."""

import dataclasses

from ledgerline.plans import adjudication, fixture, params
from ledgerline.sources.roles import Roles

from .conftest import SF_SMALL


def test_null_list_parameter_strict_and_lenient(spark):
    r = Roles(spark, SF_SMALL)
    base = fixture.REPORT
    strict = dataclasses.replace(base, batches=None, strict_null=True)
    lenient = dataclasses.replace(base, batches=None, strict_null=False)
    assert adjudication.report_files(r, strict).count() == 0
    n_all = adjudication.report_files(r, lenient).count()
    n_listed = adjudication.report_files(r, base).count()
    assert n_all > n_listed > 0      # NULL batch numbers are only kept without the filter
    assert adjudication.report_files(r, dataclasses.replace(base, batches=())).count() == 0


def test_group_header_all_text_equals_no_header(spark):
    r = Roles(spark, SF_SMALL)
    none = params.param_client_group(r, dataclasses.replace(fixture.PARAMS, group_header=None))
    all_text = params.param_client_group(r, dataclasses.replace(fixture.PARAMS, group_header=("all ",)))
    assert none.exceptAll(all_text).count() == 0 and all_text.exceptAll(none).count() == 0


def test_group_header_prefix_and_exact(spark):
    r = Roles(spark, SF_SMALL)
    out = [row.client for row in params.param_client_group(
        r, dataclasses.replace(fixture.PARAMS, group_header=("gr07", "GR12-2"))).collect()]
    assert out and all(g.startswith("GR07") or g == "GR12-2" for g in out)
    assert out == sorted(out)


def test_corp_sentinel_and_list(spark):
    r = Roles(spark, SF_SMALL)
    every = params.param_site(r, dataclasses.replace(fixture.PARAMS, corp_ids=(" All",))).count()
    some = params.param_site(r, dataclasses.replace(fixture.PARAMS, corp_ids=("corp1", "CORP2"))).count()
    assert every > some > 0
    corp = [row.corp_id for row in params.param_corp(r, fixture.PARAMS).collect()]
    assert corp[0] == " All" and " All" in corp


def test_sentinels_follow_the_collation(spark):
    """Case and trailing blanks do not matter, leading ones do."""
    r = Roles(spark, SF_SMALL)

    def sites(*corp):
        return params.param_site(r, dataclasses.replace(fixture.PARAMS, corp_ids=corp)).count()

    assert sites(" ALL") == sites(" All ") == sites(" all") == sites(" All") > 0
    assert sites("All") == sites("ALL") == 0

    def groups(header):
        return params.param_client_group(r, dataclasses.replace(fixture.PARAMS, group_header=(header,))).count()

    assert groups("All  ") == groups("ALL") > 0
    assert groups(" ALL") == 0


def test_distinct_lists_fold_spellings(spark):
    from ledgerline.sources.roles import VariantRoles

    r = VariantRoles(spark, SF_SMALL)
    spellings = {x.industry for x in r.client_list.select("industry").distinct().collect()}
    listed = [x.industry for x in params.param_industry(r).collect()]
    assert {"BUILDING", "building", "BUILDING "} <= spellings
    assert len({x.rstrip(" ").upper() for x in listed}) == len(listed)
