"""Pages whose tags are not closed lose nothing else."""

import pytest

from landsync.llm import dom


def shown(source):
    return " ".join(t for t in dom.Page(source).text if t)


@pytest.mark.parametrize("source, want", [
    ("<html><head><title>x</title><body><article><p>All", "All"),
    ("<html><head><meta charset=utf-8><title>x</title><p>All", "All"),
    ("<html><head><title>x</title>All", "All"),
    ("<head><script>'<div>'</script><title>x</title></head><body>All", "All"),
    ("<head><title>x</title></head><header>All</header>", "All"),
    ("<p>a<svg width=1/> b<svg><text>no</text></svg> c", "a b c"),
    ("<p>a<object data=x> b</p><object><p>c", "a b c"),
    ("<p>a<template-card>b</template-card> c<template>no</template>", "a b c"),
    ("<p>a<iframe src=x> b<noscript>no</noscript >c", "a bc"),
    ("<p>a<script>no</script foo>b<style>no", "ab"),
])
def test_unclosed_tags_drop_nothing_else(source, want):
    assert shown(source) == want


def test_many_unclosed_tags():
    assert shown("<object>a " * 50_000).count("a") == 50_000
