"""The ranked patterns of packed instructions, as a table bucketed by the letters that a mnemonic begins with."""

from __future__ import annotations

import re

# A pattern of the whole mnemonic and what is assigned to the first operand, by rank; the first row that fits answers.
# `exception` stands for a body that only raises the mnemonic.
RANKED = r"""
v?add[ps][sdh]      b::add(o2(), o3())
v?sub[ps][sdh]      b::sub(o2(), o3())
v?mul[ps][sdh]      b::mul(o2(), o3())
v?div[ps][sdh]      b::unsigned_div(o2(), o3())
v?min[ps][sdh]      b::sub(o2(), o3())
v?max[ps][sdh]      b::sub(o3(), o2())
v?padd[bwdq]        b::add(o2(), o3())
v?padds[bw]         b::add(o2(), o3())
v?paddus[bw]        b::add(o2(), o3())
v?psub[bwdq]        b::sub(o2(), o3())
v?psubs[bw]         b::sub(o2(), o3())
v?psubus[bw]        b::sub(o2(), o3())
v?pmull[wdq]        b::mul(o2(), o3())
v?pmulh[wu]?w       b::mul(o2(), o3())
v?pmuldq            b::mul(o2(), o3())
v?pmuludq           b::mul(o2(), o3())
v?pmaddwd           b::mul(o2(), o3())
v?pmaddubsw         b::mul(o2(), o3())
v?pand[dq]?         b::and(o2(), o3())
v?pandn[dq]?        b::and(u::not(o2()), o3())
v?por[dq]?          b::or(o2(), o3())
v?pxor[dq]?         b::xor(o2(), o3())
v?andps             b::and(o2(), o3())
v?andpd             b::and(o2(), o3())
v?andnps            b::and(u::not(o2()), o3())
v?andnpd            b::and(u::not(o2()), o3())
v?orps              b::or(o2(), o3())
v?orpd              b::or(o2(), o3())
v?xorps             b::xor(o2(), o3())
v?xorpd             b::xor(o2(), o3())
v?psll[wdq]         b::shl(o2(), o3())
v?psrl[wdq]         b::shr(o2(), o3())
v?psra[wd]          b::sar(o2(), o3())
v?pslldq            b::shl(o2(), o3())
v?psrldq            b::shr(o2(), o3())
v?psllv[dwq]        b::shl(o2(), o3())
v?psrlv[dwq]        b::shr(o2(), o3())
v?psrav[dwq]        b::sar(o2(), o3())
v?pcmpeq[bwdq]      b::equal(o2(), o3(), o1_size())
v?pcmpgt[bwdq]      b::signed_less(o3(), o2(), o1_size())
v?pmins[bwd]        b::sub(o2(), o3())
v?pminu[bwd]        b::sub(o2(), o3())
v?pmaxs[bwd]        b::sub(o3(), o2())
v?pmaxu[bwd]        b::sub(o3(), o2())
v?pabs[bwd]         o2()
v?movaps            o2()
v?movapd            o2()
v?movups            o2()
v?movupd            o2()
v?movdqa\d*         o2()
v?movdqu\d*         o2()
v?movss             o2()
v?movsd             o2()
v?movd              o2()
v?movq              o2()
v?movlps            o2()
v?movhps            o2()
v?movlpd            o2()
v?movhpd            o2()
v?movlhps           o2()
v?movhlps           o2()
v?movmskps          o2()
v?movmskpd          o2()
v?movntps           o2()
v?movntpd           o2()
v?movntdq           o2()
v?movntdqa          o2()
v?movnti            o2()
v?lddqu             o2()
v?cvt.*             u::zero_extend(o2())
v?pmov[sz]x.*       u::sign_extend(o2())
v?punpck[lh][bwdq]+ o2()
v?unpcklps          o2()
v?unpckhps          o2()
v?unpcklpd          o2()
v?unpckhpd          o2()
v?packss.*          o2()
v?packus.*          o2()
v?shufps            o2()
v?shufpd            o2()
v?pshufd            o2()
v?pshufhw           o2()
v?pshuflw           o2()
v?pshufb            o2()
v?palignr           o2()
v?pblendw           o2()
v?pblend[dv]b?      o2()
v?blendps           o2()
v?blendpd           o2()
v?blendvps          o2()
v?blendvpd          o2()
v?vperm\w+          o2()
v?perm\w+           o2()
v?vpermi2\w+        o2()
v?broadcast\w*      o2()
v?pbroadcast\w*     o2()
vbroadcast\w*       o2()
vpbroadcast\w*      o2()
v?gather\w*         o2()
v?pgather\w*        o2()
v?scatter\w*        o2()
v?pscatter\w*       o2()
v?fmadd\w+          b::add(b::mul(o2(), o3()), o3())
v?fmsub\w+          b::sub(b::mul(o2(), o3()), o3())
v?fnmadd\w+         b::add(u::neg(b::mul(o2(), o3())), o3())
v?fnmsub\w+         b::sub(u::neg(b::mul(o2(), o3())), o3())
v?fmaddsub\w+       b::add(b::mul(o2(), o3()), o3())
v?fmsubadd\w+       b::sub(b::mul(o2(), o3()), o3())
v?sqrtps            o2()
v?sqrtpd            o2()
v?sqrtss            o2()
v?sqrtsd            o2()
v?rsqrtps           o2()
v?rsqrtss           o2()
v?rcpps             o2()
v?rcpss             o2()
v?cmpps             b::equal(o2(), o3(), o1_size())
v?cmppd             b::equal(o2(), o3(), o1_size())
v?cmpss             b::equal(o2(), o3(), o1_size())
v?cmpsd             b::equal(o2(), o3(), o1_size())
v?u?comiss          b::sub(o1(), o2())
v?u?comisd          b::sub(o1(), o2())
v?pcmpestri         o2()
v?pcmpestrm         o2()
v?pcmpistri         o2()
v?pcmpistrm         o2()
v?aes\w+            exception
v?pclmulqdq         exception
sha\w+              exception
crc32               exception
v?haddps            b::add(o2(), o3())
v?haddpd            b::add(o2(), o3())
v?hsubps            b::sub(o2(), o3())
v?hsubpd            b::sub(o2(), o3())
v?phadd[wd]         b::add(o2(), o3())
v?phaddsw           b::add(o2(), o3())
v?phsub[wd]         b::sub(o2(), o3())
v?phsubsw           b::sub(o2(), o3())
v?psadbw            b::sub(o2(), o3())
v?mpsadbw           b::sub(o2(), o3())
v?dpps              b::mul(o2(), o3())
v?dppd              b::mul(o2(), o3())
v?pinsrb            o2()
v?pinsrw            o2()
v?pinsrd            o2()
v?pinsrq            o2()
v?insertps          o2()
v?pextrb            o2()
v?pextrw            o2()
v?pextrd            o2()
v?pextrq            o2()
v?extractps         o2()
v?maskmov\w*        o2()
v?pmaskmov\w*       o2()
v?ptest             b::and(o1(), o2())
v?vtestps           b::and(o1(), o2())
v?vtestpd           b::and(o1(), o2())
v?roundps           o2()
v?roundpd           o2()
v?roundss           o2()
v?roundsd           o2()
v?vrndscale\w*      o2()
v?pmovsx\w+         u::sign_extend(o2())
v?pmovzx\w+         u::zero_extend(o2())
v?compress\w*       o2()
v?expand\w*         o2()
v?conflict\w*       o2()
v?pternlog\w*       b::xor(o2(), o3())
v?movbe             o2()
v?pclmulqdq         exception
v?vpclmul\w*        exception
v?gf2p8\w*          exception
"""


def ranked() -> list[tuple[int, str, str]]:
    """(rank, pattern, expression) of every row."""
    return [(i, *line.split(None, 1)) for i, line in enumerate(RANKED.strip().split("\n"))]


def keys(pattern: str) -> set[str]:
    """The two letters that a mnemonic which fits may have after its first v, if it begins with one."""
    forms = {pattern}
    while any("?" in f[:4] for f in forms):  # letters that may be missing: v?, u?
        forms = {g for f in forms for g in ((re.sub(r"^(\w?)(\w)\?", r"\1\2", f, count=1), re.sub(r"^(\w?)\w\?", r"\1", f, count=1)) if "?" in f[:4] else (f,))}
    return {f.removeprefix("v")[:2] for f in forms}


def buckets(body_of) -> dict[str, list[dict]]:
    """By key: the rows that may fit, by rank, with the body that body_of makes of each expression."""
    out: dict[str, list[dict]] = {}
    for rank, pattern, expression in ranked():
        for key in sorted(keys(pattern)):
            out.setdefault(key, []).append({"rank": rank, "pattern": f"^(?:{pattern})$", "body": "\n".join(body_of(expression))})
    return out
