"""A line-by-line model of a vertical, to compare the jobs with."""

import hashlib
import math
import re
from collections import Counter, defaultdict


def parse(line):
    if not line:
        return None
    if not (line.startswith("<") and line.endswith(">")):
        return ("token", line.split("\t"), None)
    name = re.match(r"</?([^\s/>]+)", line).group(1)
    attrs = dict(re.findall(r'([^\s="]+)="([^"]*)"', line))
    kind = "close" if line.startswith("</") else "empty" if line.endswith("/>") else "open"
    return (kind, name, attrs)


def run(lines, structures, atom, parent=None, nested=False, size=2, accept=lambda cols, attrs: True, column=0):
    """(unit rows, n-gram counts, ARF by n-gram, number of errors) of a list of lines."""
    names = [(s, a) for s, attrs in structures.items() for a in attrs]
    stack, table = [], {}
    units, window, grams, where, errors = [], [], Counter(), defaultdict(list), 0
    atom_open, count, total, snap = -1, 0, 0, None

    def in_force():
        elements = reversed(stack) if nested else table.values()
        out = {}
        for name, attrs, _ in elements:
            for key, value in attrs.items():
                if (name, key) in names:
                    out[f"{name}_{key}"] = value
        return out

    def end(name):
        if nested:
            return stack.pop() if stack and stack[-1][0] == name else None
        return table.pop(name, None)

    for at, line in enumerate(lines):
        event = parse(line)
        if event is None:
            continue
        kind, what, attrs = event
        if kind == "token":
            if accept(what, in_force()):
                count += 1
                window.append(what[column])
                if len(window) >= size:
                    gram = " ".join(window[-size:])
                    grams[gram] += 1
                    where[gram].append(total)
                total += 1
        elif kind in ("open", "empty"):
            if not nested and what in table:
                errors += 1
                continue
            if nested:
                stack.append((what, attrs, at))
            else:
                table[what] = (what, attrs, at)
            if kind == "empty":
                end(what)
            if what == atom:
                atom_open, count, snap = at, 0, in_force()
            elif what == parent:
                snap = in_force()
        else:
            element = end(what)
            if element is None:
                errors += 1
                continue
            if what == atom or (what == parent and atom_open < element[2]):
                units.append(tuple((snap or {}).get(f"{s}_{a}") or None for s, a in names) + (count,))
                snap, window = {}, []
    arf = {}
    for gram, places in where.items():
        v = total / len(places)
        gaps = [b - a for a, b in zip(places, places[1:])] + [places[0] + total - places[-1]]
        arf[gram] = math.floor(sum(min(v, g) for g in gaps) / v * 1000 + 0.5) / 1000
    return units, grams, arf, errors


def sha1(text):
    return hashlib.sha1(text.encode()).hexdigest()
