"""Hand-made timetable lines."""


def put(width, **fields):
    """``put(80, p3="N", p4="A00001")``: text at 1-based positions."""
    line = [" "] * width
    for key, text in fields.items():
        at = int(key[1:]) - 1
        line[at:at + len(text)] = text
    return "".join(line)


HD = put(80, p1="HD", p3="TPS.UDFROC1", p23="080598", p29="0805", p47="F", p48="A", p49="080598", p55="080599")
ZZ = put(80, p1="ZZ")


def bs(uid, stp="P", start="980101", end="981231", days="1111111", speed="075", **more):
    return put(80, p1="BSN", p4=uid, p10=start, p16=end, p22=days, p58=speed, p80=stp, **more)


def lo(place, dep, public=None):
    return put(80, p1="LO", p3=place, p11=dep, p16=public or dep[:4], p30="TB")


def li(place, arr="", dep="", passing=""):
    return put(80, p1="LI", p3=place, p11=arr, p16=dep, p21=passing, p26="0000", p30="0000", p43="T")


def lt(place, arr):
    return put(80, p1="LT", p3=place, p11=arr, p16=arr[:4], p26="TF")


def cr(place, speed="100"):
    return put(80, p1="CR", p3=place, p11="XX", p38=speed)


def write(path, lines, newline="\n", last=True):
    path.write_bytes((newline.join(lines) + (newline if last else "")).encode("latin-1"))
    return str(path)
