"""Word lists that keys are built from. Callers may pass a ``Lexicon`` of their own."""

from __future__ import annotations

from dataclasses import dataclass, field

# Results depend on them word for word.

SKIP_TABS = ("dump", "clean", "all first pass", "tool closed in phase 1 (ignore", "paypal (ignore)")

STOP_WORDS = """
a an the in on to for from with of at by and or is it my your our how do i you can does using via through into
be been being was were are am has have had will would could should shall may might must
that this these those which what where when who whom whose why so if then than but not no nor just also too very
about up out off over under again further each every all any both few more most other some such only own same between
after before during while still already use used uses way ways step steps guide tutorial example examples
best practice practices tip tips trick tricks method methods new old one two multiple several different
within without like need want try able easily quickly simple simply basic advanced
properly correctly effectively efficiently
"""

#: canonical verb: its synonyms. A canonical verb also stands for itself.
VERBS = """
create: make, build, set up, setup, generate, compose, draft, design, establish, initialize, init, provision, spin up, instantiate, define, construct, craft
add: insert, include, put, append, inject, embed, place, imbed, stick, attach
remove: delete, clear, erase, destroy, purge, discard, drop, wipe, uninstall, eliminate, get rid of, take down, take out, take off
change: edit, modify, update, alter, revise, amend, tweak, adjust, rename, customize, turn, switch
view: see, check, look, get, browse, inspect, retrieve, fetch, pull, read, list, preview, review, navigate, go to
show: display, reveal, unhide
access:
find: locate, lookup, look up, search
export: extract, save as, dump, backup, back up
download: save
import: upload, load, ingest, bring in, pull in, bulk upload, bulk import, restore
move: transfer, migrate, shift, relocate, drag, reorder, rearrange, reorganize
copy: clone, duplicate, replicate, mirror
assign: allocate, delegate, reassign, distribute
link: connect, associate, relate, map, bind, hyperlink
configure: personalize, tailor, set, specify, tune
manage: organize, handle, administer, maintain, govern, oversee, control
track: monitor, log, measure, audit, observe, watch
record: narrate, capture
enable: activate, turn on, switch on, allow
unlock:
disable: deactivate, turn off, switch off, block, restrict, mute
hide: suppress, conceal
filter: query, narrow, refine
sort:
close: complete, finish, resolve, archive, end
start: begin, launch, initiate, trigger
open:
run: execute, play
stop: pause
share: send, publish, post, broadcast, forward, submit
approve: accept, confirm, authorize, validate
deny: reject, decline, refuse
merge: combine, consolidate, unify, join, aggregate
split: separate, divide, decompose
schedule: plan, book, reserve
automate: batch, bulk
sync: synchronize, synch
integrate: integration
fix: repair, troubleshoot, debug, diagnose, solve, workaround, patch, recover
convert: transform, parse
translate:
format:
resize: scale
crop: trim
rotate:
flip:
align: center
animate:
highlight:
group:
ungroup:
print:
wrap:
cite: reference
compress: condense, shrink, minimize, reduce
write: type
draw:
indent:
outline:
install:
use:
apply:
undo:
collaborate:
annotate:
zoom:
blur:
cancel:
sign:
lock: freeze
loop: autoplay, repeat
present:
number:
exit: get out of
enter: get into
"""

NEVER_MERGE = """
add remove
show hide
enable disable
lock unlock
group ungroup
import export
download upload
enter exit
run stop
flip rotate
record add
add create
open close
start stop
"""

#: canonical object: its synonyms. A canonical object also stands for itself.
OBJECTS = """
issue: ticket, item, card, work item, request, incident, case
task:
bug: defect
story: user story, requirement
sprint: iteration, cycle
board: kanban, scrum board, kanban board, agile board
backlog: product backlog
epic: initiative
project:
workspace: space
repository: repo
folder: directory, collection
workflow: process, flow
pipeline:
automation: rule
status: state
dashboard: overview
report: graph, analytics, metrics
widget: gadget
roadmap:
timeline:
gantt:
field: custom field, attribute, property
column:
label: tag
priority: severity
notification: alert, reminder
comment: note, annotation
message: chat, dm
subtask: sub-task, child issue, child task
attachment:
file:
document:
image: screenshot
version:
release:
permission: privilege
role:
user: member
account:
profile:
admin:
template: blueprint, preset
form:
layout:
view:
page:
api: rest api, endpoint
webhook: callback
plugin: add-on, addon
extension:
app:
integration: connector, bridge
sla: service level agreement
sso: single sign on, single sign-on
subscription:
plan:
payment:
billing:
invoice:
spreadsheet: excel file
presentation:
slide: slides
video:
audio:
recording:
background: wallpaper
font:
text:
paragraph:
header:
footer:
table: grid
chart:
diagram:
transition:
animation:
theme: color scheme
"""

QUESTION_PREFIXES = ("how to ", "how do i ", "how do you ", "how can i ", "how can you ", "how can we ")
ARTICLES = ("a", "an", "the", "my", "your", "our", "this", "that")
TITLE_KEEPS = ("in", "on", "to", "from", "with")

SKIP_VALUES = (
    "name", "keyword", "keywords", "query", "term", "terms", "topic", "title", "url", "", "none",
    "pass 1", "pass 2", "pass 3", "covered", "done", "done ", "p1", "p2", "p3", "existing", "needs 1 final sonnet pass",
)
COMMAND_PREFIXES = ("python3 ", "ANTHROPIC_", "=")
CELL_PREFIXES = ("ANTHROPIC_API_KEY", "<loc>", "http")

INTEGRATION_SIGNALS = ("integration", "integrate", "connect ", "connect to", "connect with", "sync ", "synced", "connector")
HOWTO_PREFIXES = ("how to", "how do", "how can")
IRRELEVANT_TEMPLATES = (
    "{} tutorial", "how to use {}", "{} how to", "how to {}", "tutorial {}",
    "{} tutorial for beginners", "learn how to use {}", "best {} tutorial",
)
IRRELEVANT_PATTERNS = (
    "how to pronounce", "how to spell", "how to say ",
    "tutorial pdf", "tutorial video", "tutorial youtube", "tutorial udemy", "tutorial guru99", "tutorial ppt",
    "tutorial hindi", "tutorial arabic", "tutorial deutsch", "tutorial español", "tutorial français", "tutorial pl",
    "tutorial for beginners video", "tutorial for beginners pdf", "best tutorial", "free tutorial", "tutorial free",
    "tutorial 2018", "tutorial 2019", "tutorial 2020", "tutorial 2021", "tutorial 2022", "tutorial 2023", "tutorial 2024",
    "how to learn ", "certification", "interview", "resume", "what is ", "what does ", "does ", " vs ",
    "how to contact", "how to cancel subscription", "how to get a job", "salary", "hiring", "career", "pronunciation",
)

# End of fixed values.


def _synonyms(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in text.strip().splitlines():
        head, _, rest = line.partition(":")
        out |= dict.fromkeys([head.strip(), *(w.strip() for w in rest.split(",") if w.strip())], head.strip())
    return out


@dataclass(frozen=True)
class Lexicon:
    stop_words: tuple[str, ...] = tuple(STOP_WORDS.split())
    verbs: dict[str, str] = field(default_factory=lambda: _synonyms(VERBS))
    objects: dict[str, str] = field(default_factory=lambda: _synonyms(OBJECTS))
    never_merge: tuple[tuple[str, str], ...] = tuple(tuple(sorted(line.split())) for line in NEVER_MERGE.strip().splitlines())
    irrelevant: tuple[str, ...] = IRRELEVANT_PATTERNS

    @property
    def canonical_verbs(self) -> list[str]:
        return sorted(set(self.verbs.values()))

    @staticmethod
    def phrases(table: dict[str, str]) -> list[tuple[str, str]]:
        """Entries of several words, longest first; ties in the table's order."""
        return sorted(((p, c) for p, c in table.items() if " " in p), key=lambda e: -len(e[0]))


DEFAULT = Lexicon()
